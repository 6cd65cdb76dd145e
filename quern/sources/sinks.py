"""Files of training rows and reports: whole or not at all, and no private text among them."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.operators.assemble import united
from quern.sources.jsonl import read_jsonl, write_jsonl


def merge_report(path: str, key: str, value: object) -> None:
    """Replaces one key of a JSON report, which is made if it isn't there; keys are sorted."""
    file = Path(path)
    said = json.loads(file.read_text("utf-8")) if file.exists() else {}
    file.parent.mkdir(parents=True, exist_ok=True)
    beside = file.with_name(file.name + ".new")
    beside.write_text(json.dumps(said | {key: value}, indent=2, sort_keys=True, ensure_ascii=False) + "\n", "utf-8")
    os.replace(beside, file)


def write_splits(df: DataFrame, folder: str, split: str = "split", least: int = fixed.BATCH_ROWS) -> dict[str, str]:
    """Writes train and valid as folders of JSON lines, without the split column; returns a warning for each with fewer rows than a batch."""
    counts = {r[split]: r["n"] for r in df.groupBy(split).agg(F.count("*").alias("n")).collect()}
    for name in ("train", "valid"):
        write_jsonl(df.filter(F.col(split) == name).drop(split), f"{folder}/{name}")
    return {name: f"{name} has {counts.get(name, 0)} rows; a batch needs {least}" for name in ("train", "valid") if counts.get(name, 0) < least}


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _moved(spark: SparkSession, path: str, to: str) -> None:
    files, where = _files(spark, path)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} can't be moved")


def filter_splits(spark: SparkSession, folder: str, schema: str, too_long: Column, id_col: str = "id", most: float = 0.01) -> list[tuple[str, str]]:
    """Rewrites train and valid without the rows that are too long; returns their (split, id).

    The decision comes first: if more than a share of most would go, that is an error and every file stays
    as it was. The original of a split that loses rows is kept as <split>.unfiltered, and a later run
    filters that one, so it gives the same rows. A rewritten split is written beside its place and then moved.
    """
    splits, total, dropped = {}, 0, []
    for name in ("train", "valid"):
        whole = f"{folder}/{name}.unfiltered"
        files, where = _files(spark, whole)
        rows = read_jsonl(spark, whole if files.exists(where) else f"{folder}/{name}", schema)
        over = [r[0] for r in rows.filter(too_long).select(F.col(id_col).cast("string")).orderBy(id_col).collect()]
        splits[name] = (rows, over, files.exists(where))
        total, dropped = total + rows.count(), dropped + [(name, i) for i in over]
    if total and len(dropped) > most * total:
        raise ValueError(f"{len(dropped)} of {total} rows are too long")
    for name, (rows, over, kept) in splits.items():
        if over:
            write_jsonl(rows.filter(~F.coalesce(too_long, F.lit(False))), f"{folder}/{name}.new")
            if kept:
                files, where = _files(spark, f"{folder}/{name}")
                files.delete(where, True)
            else:
                _moved(spark, f"{folder}/{name}", f"{folder}/{name}.unfiltered")
            _moved(spark, f"{folder}/{name}.new", f"{folder}/{name}")
    return dropped


def is_private(path: str) -> bool:
    """Whether a file lies below data/private, by the path as given or by the one that links lead to."""
    given = Path(path.removeprefix("file://"))
    return any(pair == ("data", "private") for p in (given.absolute(), given.resolve()) for pair in zip(p.parts, p.parts[1:]))


def write_picks(picks: DataFrame, path: str, source: str = "source") -> DataFrame:
    """Writes picked rows as JSON lines in the order of their number and returns counts only: (source, kept)."""
    write_jsonl(picks, path, "number")
    return picks.groupBy(source).agg(F.count("*").alias("kept"))


def read_all_seeds(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The rows of all files; a file without rows is an error."""
    tables = []
    for path in paths:
        rows = read_jsonl(spark, path, schema)
        if rows.isEmpty():
            raise ValueError(f"no seeds in {path}")
        tables.append(rows)
    return united(*tables)

"""What the operators of this subpackage share: tables, shared folders and Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset and all run on one machine; else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="quern-"))
    return f"file://{_local[0]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quern/{name}-{uuid.uuid4().hex}"


#: Rows that Spark sends to a Python worker at a time while a table is written: texts are long, and a batch stands in the JVM and in the worker.
BATCH_ROWS = 2_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for one write, then as it was."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, texts: bool = False, codec: str = "zstd") -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage and survives lost executors. texts: Python workers read whole texts for it, so batches are kept small."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    rows = int(spark.conf.get(_BATCH_CONF))
    with _setting(spark, _BATCH_CONF, str(min(rows, BATCH_ROWS) if texts and rows > 0 else rows)):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_kinds(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Writes rows of a few kinds as a folder for each kind; every task has a file open for each, so it needs no sort by kind."""
    with _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "8"):
        df.write.option("compression", codec).partitionBy("kind").parquet(path)


def same_text(text_col: str = "text") -> Column:
    """The hash of a row's text; with its id, what tells rows apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def in_rows(docs: DataFrame, chosen: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with (left_semi) or without (left_anti) their (doc_id, same) in chosen; null ids are equal."""
    keys = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("same").alias("chosen_same"))
    match = F.col(id_col).cast("long").eqNullSafe(F.col("chosen_id")) & (same_text(text_col) == F.col("chosen_same"))
    return docs.join(keys, match, how)


#: A key of at least so many rows, and of at least a thousandth of all rows, is hot; so at most a thousand keys are.
HOT_ROWS = 10_000


def with_labels(rows: DataFrame, labels: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """rows joined to labels, which has each value of key once with n_rows, the number of its rows; null keys stay, without labels.

    Labels of hot keys, at most a thousand by the definition of hot, are broadcast, so that a key with a
    third of all rows is not moved to one task; the others are joined by a shuffle.
    """
    labels = written(labels, "labels")
    total = labels.agg(F.sum("n_rows")).first()[0] or 0
    hot = labels.filter(F.col("n_rows") >= (hot_rows or max(HOT_ROWS, total / 1000))).withColumn("n_hot", F.lit(True))
    near = rows.join(F.broadcast(hot), key, "left").filter(F.col("n_hot") | F.col(key).isNull()).drop("n_hot", "n_rows")
    cold = rows.filter(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti")
    return near.unionByName(cold.join(labels.drop("n_rows"), key, "left"))


def texts_of(column: pa.Array) -> list[str]:
    """A text column as Python strings; null counts as the empty text."""
    return [x or "" for x in column.to_pylist()]


def pieces(batch: pa.RecordBatch, rows: int = 512, size: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts a batch into parts of at most so many rows, and of about so many bytes of the given column."""
    array = batch.column(batch.schema.get_field_index(column))
    lengths = pa.compute.binary_length(array).fill_null(0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and (total + n > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers live on after their task

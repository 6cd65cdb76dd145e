"""What the queries share: tables, texts with literal snippets so that every rule fires, and SQL pieces for DuckDB."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query and, if there is one, its SQL."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",)))


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def chosen(snippets: Sequence[str]) -> Column:
    """One snippet for each row, by doc_id."""
    return F.element_at(F.array(*[F.lit(s) for s in snippets]), (F.col("doc_id") % len(snippets) + 1).cast("int"))


def sql_chosen(snippets: Sequence[str]) -> str:
    return f"([{', '.join(map(q, snippets))}])[doc_id % {len(snippets)} + 1]"


def with_snippet(docs: DataFrame, snippets: Sequence[str], before: bool = False) -> DataFrame:
    s = chosen(snippets)
    return docs.withColumn("text", F.concat(s, F.col("text")) if before else F.concat(F.col("text"), s))


def sql_with(snippets: Sequence[str], before: bool = False, extra: str = "") -> str:
    s = sql_chosen(snippets)
    return f"(SELECT doc_id{extra}, {f'{s} || text' if before else f'text || {s}'} AS text FROM documents)"


WS = r"[\s\x0b]+"


def sql_words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}'), lambda w: w <> '')"


def sql_u(seed: str, *parts: str) -> str:
    key = " || '|' || ".join([q(seed), *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"('0x' || substr(sha256({key}), 1, 15))::BIGINT"


def sql_signoff(c: str) -> str:
    lines = f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '')"
    return f"CASE WHEN len({lines}) >= 2 AND len({sql_words(f'({lines})[-1]')}) <= 4 THEN ({lines})[-1] END"


def sql_straight(c: str) -> str:
    return f"translate({c}, '’‘ʼ', '''''''')"

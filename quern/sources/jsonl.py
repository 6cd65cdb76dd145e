"""JSON lines, text seeds and term lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.functions.text import stripped


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, torn: bool = False) -> DataFrame:
    """A row a line; a malformed line is an error, or with torn left out. Blank lines and a byte order mark are skipped."""
    if not torn:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_jsonl(df: DataFrame, path: str, order: str | None = None) -> None:
    """UTF-8, null fields left out; with an order, range partitions in that order."""
    (df.orderBy(order) if order else df).write.mode("overwrite").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """(text, writer, source, license) of a file with a text a line; # comments; the two characters \\n are a line break."""
    lines = spark.read.text(path).select(stripped(F.col("value")).alias("text"), F.col("_metadata.file_name").alias("source"))
    kept = lines.filter((F.col("text") != "") & ~F.col("text").startswith("#"))
    return kept.select(F.replace("text", F.lit("\\n"), F.lit("\n")).alias("text"), F.lit("v1").alias("writer"), "source", F.lit("MIT").alias("license"))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """(term): a term a line, without what follows a #."""
    return spark.read.text(path).select(stripped(F.split_part("value", F.lit("#"), F.lit(1))).alias("term")).filter("term <> ''")


def read_dictionary(spark: SparkSession, *paths: str) -> DataFrame:
    """(word): a word a line; only whole lines are comments."""
    return spark.read.text(list(paths)).filter(~F.col("value").startswith("#")).select(stripped(F.col("value")).alias("word")).filter("word <> ''").distinct()


def read_pages(spark: SparkSession, path: str, source: str, row_schema: str) -> DataFrame:
    """Rows of one source of a JSON file {source: [page of rows, ...]}."""
    whole = spark.read.schema(f"`{source}` array<array<struct<{row_schema}>>>").option("multiLine", True).json(path)
    return whole.select(F.explode(F.flatten(F.col(source))).alias("row")).select("row.*")

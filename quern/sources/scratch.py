"""Cutting the lineage of plans through the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where that is unset and all run on one machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="quern-"))
    return f"file://{_own[0]}"


_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialised(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: computed once, read by column, and there when executors are lost. batch_rows: what Spark sends to a Python worker at a time meanwhile, at most."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern/{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH_CONF)
    if batch_rows and not 0 < int(before) <= batch_rows:
        spark.conf.set(_BATCH_CONF, str(batch_rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)

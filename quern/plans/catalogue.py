"""All queries over the test tables and their SQL twins, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.plans import table_queries, text_queries
from quern.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gated, deduplicated documents with noisy variants, split and scored."""
    return table_queries.training_pairs(spark, sf_dir)

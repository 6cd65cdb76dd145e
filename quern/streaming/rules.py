"""The stateless rules over streams: the same columns as in batch, so a stream and a table give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import rules


def gated(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """texts, a batch or a stream, with reason: the first failing rule of the gate, null for none."""
    c = F.col(text_col)
    reason = F.coalesce(rules.wrapper_reason(c), rules.known_error_reason(c), rules.length_reason(c), F.concat(F.lit("pii_"), rules.pii_reason_any(c)))
    return texts.withColumn("reason", reason)


def reason_counts(texts: DataFrame, time_col: str, text_col: str = "text", window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """How often each reason stood in each window of time; rows later than the watermark are left out."""
    return gated(texts, text_col).withWatermark(time_col, late).groupBy(F.window(time_col, window), F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def judged(texts: DataFrame, verdict: Column, text_col: str = "text") -> DataFrame:
    """Texts that pass the gate with a judge's verdict, asked only for those."""
    return gated(texts, text_col).filter("reason IS NULL").drop("reason").withColumn("verdict", verdict)

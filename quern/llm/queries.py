"""One query for each operator of this subpackage, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import cap_filters, context_mixing, decontaminate, html_text, language_id, line_dedup, mixing, simhash, token_counts, token_store
from quern.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op6_simhash"] = op6_simhash


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


QUERIES["op7_line_dedup"] = op7_line_dedup
ORACLES["op7_line_dedup"] = line_dedup.SQL


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_back(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "n_chunks")


QUERIES["op1_token_store"] = op1_token_store


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op2_token_counts"] = op2_token_counts


def op3_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES["op3_cap_filters"] = op3_cap_filters
ORACLES["op3_cap_filters"] = cap_filters.SQL


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


QUERIES["op8_html_text"] = op8_html_text


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op9_decontamination"] = op9_decontamination


#: Shares of tokens that the mixing query aims for, by the domains that the table of labels names.
MIX = {"good": 0.90, "low": 0.08, "toxic": 0.02}


def label_domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_domain(), MIX)
    return rows.select("doc_id", "n_tokens", "p", "rate", "copies")


QUERIES["op4_mixing"] = op4_mixing


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both documents and pages: a document declares its lang and its source is its host; a page declares its markup's."""
    docs = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    first = docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), none.alias("address"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", language_id.declared_of(F.col("html")).alias("declared"), language_id.host_of(F.col("url")).alias("host"))
    texts = html_text.extracted(pages, "html", ("page_id", "declared", "host"))
    second = texts.select(F.lit(None).cast("long").alias("doc_id"), "page_id", "text", "declared", "host", F.col("host").alias("address"))
    model = language_id.fit_text_model(docs, "doc_id", "text", F.col("lang"))
    found = language_id.identified(first.unionAll(second), model, "text", F.col("declared"), F.col("host"), F.col("address"), keep=["doc_id", "page_id"])
    return found.select("doc_id", "page_id", F.col("lid_lang").alias("lang"), F.col("lid_confidence").alias("confidence"), F.col("lid_accepted").alias("accepted"))


QUERIES["op10_language_id"] = op10_language_id


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scored(table(spark, sf_dir, "documents"))


QUERIES["op5_context_mixing"] = op5_context_mixing

"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage but the last returns the columns of documents. Rows without text or in no known language
go in the first; one row of each near-duplicate group (five-word shingles, similarity 0.8 at least) stays after
the second; documents that hold benchmark items go in the third; the fourth keeps a document with the
probability of its rate, which is at most one; the last returns the token store's rows. A row is known by
its doc_id and the hash of its text, so one with a null doc_id is judged like any other, and different
texts under one doc_id are judged apart.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, language_id, mixing, shingle_groups, token_store
from quern.llm.common import in_rows, same_text, scratch_path, table, written
from quern.llm.queries import MIX, label_domain

#: SQL can't express hashed classifiers, fingerprints or tokenizers; tests hold the stages against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; lang is what they declare and source is their host."""
    model = language_id.fit_text_model(docs, "doc_id", "text", F.col("lang"))
    found = language_id.identified(docs, model, "text", F.col("lang"), F.col("source"), keep=docs.columns)
    return found.filter("lid_accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group linked by five-word shingles of similarity 0.8 at least: the smallest doc_id, null after all others."""
    kept = in_rows(docs, shingle_groups.first_rows(docs), "left_semi").withColumn("same", same_text())
    return kept.dropDuplicates(["doc_id", "same"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.contaminated_rows(docs, table(spark, sf_dir, "benchmark")).filter(F.size("item_ids") > 0)
    return in_rows(docs, written(found.select("doc_id", "same").distinct(), "leaks"), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned towards the target weights; none is repeated."""
    rows = mixing.mixed(docs, table(spark, sf_dir, "labels"), label_domain(), MIX, most=1.0)
    return in_rows(docs, rows.filter("copies > 0").select("doc_id", "same").distinct(), "left_semi")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token store and returns what reading it back gives."""
    path = scratch_path(spark, "store")
    token_store.write_store(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_back(spark, path)


STAGES = [("language_id", known_language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mix), ("token_output", token_output)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Rows without a doc_id, and different texts under one doc_id, are judged by their own text in every stage."""

import pytest

import corpus_pipeline
from quern.llm import decontaminate


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("rows"))
    bench = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "red orange yellow green blue indigo violet black white grey pink brown")]
    spark.createDataFrame(bench, "item_id long, text string").coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    return d, bench


def test_leaks(spark, tables):
    d, bench = tables
    rows = [(None, "clean text"), (None, "x " + bench[0][1]), (3, "another clean text"), (3, bench[1][1] + " y"), (4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.decontamination(spark, docs, d).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[4]], key=str)


def test_repeated_rows_over_shards(spark, tables, monkeypatch):
    d, bench = tables
    rows = [(None, bench[0][1]), (None, "clean"), (3, bench[1][1]), (3, bench[1][1]), (3, "clean"), (5, bench[0][1] + " " + bench[1][1])]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{d}/benchmark.parquet")
    want = sorted([(None, True, 1, [1]), (None, False, 0, []), (3, True, 1, [2]), (3, True, 1, [2]), (3, False, 0, []), (5, True, 2, [1, 2])], key=str)
    for size in (decontaminate.SHARD, 50):
        monkeypatch.setattr(decontaminate, "SHARD", size)
        assert sorted(map(tuple, decontaminate.contamination(docs, items).collect()), key=str) == want


def test_mixing_keeps_rows_without_an_id(spark, tables, tmp_path, prose):
    texts = prose(60, 9, 30)
    rows = [(i, t + (" bad worse" if i % 6 == 0 else " foul vile" if i % 6 == 1 else " fine good")) for i, t in enumerate(texts)]
    labels = [(i, 0 if i % 6 == 0 else 1, 1 if i % 6 == 1 else 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows += [(None, t + " fine good") for t in prose(20, 10, 30)] + [(2, "other words fine good")]
    got = corpus_pipeline.mix(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert len([r for r in got if r["doc_id"] is None]) >= 15

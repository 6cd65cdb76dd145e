"""Whole texts go through the pair filter."""

import random

from quern.plans import catalogue


def test_pair_filter_sees_words_past_the_fortieth(spark, tmp_path):
    r = random.Random(5)
    pool = "the cat went home and then they were there because it is the best that we could have with their own house".split()
    texts = [(i, " ".join(r.choice(pool) for _ in range(45)) + (" write to ann.lee@example.com today" if i < 100 else " and more words" * 20 if i < 150 else " today.")) for i in range(200)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["id"]: x["reason"] for x in catalogue.QUERIES["pair_filter"](spark, str(tmp_path)).collect()}
    assert all(got[i] == "word_count" for i in range(100, 150))
    assert any((got[i] or "").startswith("pii_") for i in range(100))

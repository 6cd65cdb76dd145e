"""The pipeline's near-duplicate stage against all pairs by exact similarity."""

import random

import corpus_pipeline
from quern.llm import shingle_groups


def _similarity(a, b):
    x, y = (set(shingle_groups.shingles(t).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def _edited(text, least, r):
    """Random word edits, as many as keep the similarity at least so high."""
    now = text.split()
    while True:
        new = list(now)
        new[r.randrange(len(new))] = f"edit{r.randrange(10**6)}"
        if _similarity(text, " ".join(new)) < least:
            return " ".join(now)
        now = new


def _kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    out = corpus_pipeline.near_dedup(spark, df, "")
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_copies_of_similarity_eight_tenths_go(spark, prose):
    r, base = random.Random(3), prose(40, 11, 200)
    rows = list(enumerate(base))
    for k, least in enumerate((0.8, 0.85, 0.9, 0.95)):
        rows += [(100 * (k + 1) + i, _edited(t, least, r)) for i, t in enumerate(base)]
    below = [(900 + i, " ".join(t.split()[:150])) for i, t in enumerate(base)]  # similarity under 0.8 to all others
    assert all(_similarity(t, base[i - 900]) < 0.8 for i, t in below)
    rows += [(i, t) for i, t in below]
    chosen = [(i, t, 0) for i, t in rows]
    near = {}
    for i, t, _ in chosen:  # groups by all pairs
        near[i] = {i}
    sets = {i: set(shingle_groups.shingles(t).tolist()) for i, t, _ in chosen}
    for i in sets:
        for j in sets:
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and near[i] is not near[j]:
                near[i] |= near[j]
                for k in near[i]:
                    near[k] = near[i]
    first = {min(x) for x in near.values()}
    assert not first & set(range(100, 500))
    assert {i for i, _ in _kept(spark, chosen)} == first
    df = spark.createDataFrame(chosen, "doc_id long, text string, n int")
    sliced = shingle_groups.first_rows(df, most=2000)
    assert {x["doc_id"] for x in sliced.collect()} == first


def test_null_ids_and_repeated_ids(spark, prose):
    a, b, c = prose(3, 12)
    rows = [(None, a, 0), (None, b, 0), (5, b, 0), (7, c, 0), (7, a + " x", 0), (7, c, 0), (8, "", 0), (9, None, 0), (10, "one two", 0), (11, "ONE two", 0)]
    got = _kept(spark, rows)
    assert got == sorted([(5, b), (7, c), (7, a + " x"), (8, ""), (10, "one two")], key=str)
    assert _kept(spark, [(None, a, 0), (None, b, 0)]) == sorted([(None, a), (None, b)], key=str)
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame([], "doc_id long, text string"), "").count() == 0

"""Candidates of the pipeline's near-duplicate stage come from wide fingerprints in the Gray-order index."""

import random

import numpy as np

import corpus_pipeline
from quern.llm import shingle_groups, simhash


def _near(a, b):
    return 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))


def test_fingerprint_against_a_count_of_bits():
    for n in (4, 5, 255, 256, 700):
        h = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64)
        x = (h[None] ^ simhash._ODD[0]) * simhash._ODD[1]
        x = (x ^ (x >> np.uint64(29))) * simhash._ODD[2]
        x ^= x >> np.uint64(32)
        want = [sum(1 << b for b in range(64) if 2 * sum(int(y) >> b & 1 for y in word) > n) for word in x]
        assert simhash.wide_fingerprint(h).tolist() == want


def test_index_of_many_small_units_finds_pairs_at_eight_tenths(spark, prose):
    r, texts = random.Random(5), prose(400, 21, 120)
    sets = [shingle_groups.shingles(t) for t in texts]
    for own in sets[:400]:  # a ninth of the set is another: 8/9 in common, similarity 0.8 or just above
        other = own.copy()
        k = len(own) // 9
        other[r.sample(range(len(own)), k)] = [r.getrandbits(63) for _ in range(k)]
        sets.append(np.unique(other))
    assert all(_near(sets[i], sets[400 + i]) for i in range(400))
    reps = spark.createDataFrame([(i, bytearray(simhash.wide_fingerprint(s).tobytes())) for i, s in enumerate(sets)], "rep long, print binary")
    for unit_rows, slice_rows in ((8, 1000), (100, 10), (1000, 1000)):
        group = list(range(len(sets)))
        edges = simhash.wide_links(reps, shingle_groups.COSINE, unit_rows, slice_rows).collect()
        for _ in range(len(sets)):
            before = list(group)
            for a, b in edges:
                group[a] = group[b] = min(group[a], group[b])
            if group == before:
                break
        assert group == [i % 400 for i in range(800)]  # every pair, and no others


def test_the_stage_takes_its_candidates_from_the_index(spark, prose, monkeypatch):
    a = prose(1, 30, 200)[0]
    df = spark.createDataFrame([(1, a), (2, a + " end")], "doc_id long, text string")
    assert [x["doc_id"] for x in corpus_pipeline.near_dedup(spark, df, "").collect()] == [1]
    asked = []
    monkeypatch.setattr(shingle_groups, "wide_links", lambda reps, cosine: (asked.append(cosine), spark.createDataFrame([], "a long, b long"))[1])
    assert corpus_pipeline.near_dedup(spark, df, "").count() == 2
    assert asked == [shingle_groups.COSINE]

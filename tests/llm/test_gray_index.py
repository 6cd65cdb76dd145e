"""The Gray tree makes the links of every unit, small ones too, and prunes groups above the leaves."""

import numpy as np
import pytest

from quern.llm import simhash
from quern.llm.common import with_labels


def in_gray_order(v):
    g = v.copy()
    for k in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(k)
    return v[np.argsort(g)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 64, 300])
def test_forest_of_any_size_against_all_pairs(n):
    r = np.random.default_rng(n)
    base = r.integers(0, 1 << 63, max(1, n // 3), np.uint64)
    flips = [np.uint64(1) << r.integers(0, 63, n).astype(np.uint64) for _ in range(3)]
    v = in_gray_order(np.unique(base[r.integers(0, len(base), n)] ^ flips[0] ^ flips[1] ^ flips[2]))
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 3
    want = np.arange(len(v))
    for _ in range(len(v)):
        want = np.where(near, want[None, :], len(v)).min(1)
    assert simhash.GrayTree(v).forest(3).tolist() == want.tolist()


def test_groups_are_pruned_above_the_leaves():
    v = in_gray_order(np.unique(np.random.default_rng(1).integers(0, 1 << 63, 2000, np.uint64)))
    tree = simhash.GrayTree(v)
    leaves = -(-len(v) // simhash.LEAF)
    left = len(tree.near_leaves(3)[0])
    assert sum(tree.dropped[:-1]) > 0 and left < leaves * (leaves + 1) / 2 / 3


def test_units_of_the_query_use_the_tree(spark, prose, monkeypatch):
    """With units of the size that the query aims for, links come from trees of several leaves."""
    seen = []
    forest = simhash.GrayTree.forest
    monkeypatch.setattr(simhash.GrayTree, "forest", lambda self, limit: (seen.append(len(self.levels[0][0])), forest(self, limit))[1])
    fps = np.sort(np.array([simhash.fingerprint(simhash.shingle_hashes(t)) for t in prose(400, 3)], np.uint64))
    bits = max(1, int(np.ceil(np.log2(len(fps) / simhash.UNIT + 1))))
    unit = (fps >> np.uint64(64 - bits)).astype(np.int64)
    simhash._forest_edges(np.concatenate([in_gray_order(fps[unit == u]) for u in np.unique(unit)]), np.sort(unit), np.arange(len(fps)), 3)
    assert len(seen) > 1 and min(seen) > 8


def test_labels_of_hot_and_other_keys(spark):
    rows = spark.createDataFrame([(i, None if i == 40 else 7 if i < 30 else i) for i in range(41)], "id long, k long")
    labels = rows.filter("k is not null").groupBy("k").count().selectExpr("k", "k * 2 AS name", "count AS n_rows")
    for hot in (1, 20, 1000):
        got = with_labels(rows, labels, "k", hot).collect()
        assert sorted((r["id"], r["name"]) for r in got if r["k"] is not None) == [(i, 14 if i < 30 else 2 * i) for i in range(40)]
        assert [r["name"] for r in got if r["k"] is None] == [None]

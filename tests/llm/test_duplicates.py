"""SimHash groups, cap filters and line dedup against brute force."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from quern.llm import cap_filters, line_dedup, simhash
from quern.llm.components import components


def closed(n, pairs):
    lab = list(range(n))
    for _ in range(n):
        before = list(lab)
        for a, b in pairs:
            lab[a] = lab[b] = min(lab[a], lab[b])
        if lab == before:
            return lab
    return lab


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = closed(341, pairs)
    assert found == {i: want[i] for i in range(341) if want[i] != i}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links_and_slices(spark):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = [0] + base + [b ^ sum(1 << r.randrange(64) for _ in range(r.randint(1, 5))) & (2**64 - 1) for b in base for _ in range(6)]
    hub = r.getrandbits(64)
    fps += [hub ^ (1 << i) for i in range(64)] + [hub ^ (1 << i) ^ (1 << j) for i in range(0, 64, 7) for j in range(1, 64, 5) if i != j]
    fps = sorted(set(fps))
    r.shuffle(fps)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    want = closed(len(fps), pairs)
    rows = spark.createDataFrame([(i, f - (f >> 63 << 64)) for i, f in enumerate(fps)], "rep long, fp long")
    for size in (20, 100_000):
        found = {x["node"]: x["component"] for x in components(simhash.links(rows, 3, size)).collect()}
        assert [found.get(i, i) for i in range(len(fps))] == want


def test_gray_tree_keeps_every_near_pair():
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 40, np.uint64)
    v = np.unique(np.concatenate([base ^ (np.uint64(1) << r.integers(0, 63, 40).astype(np.uint64)) for _ in range(20)]))
    g = v.copy()
    for k in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(k)
    v = v[np.argsort(g)]
    tree = simhash.GrayTree(v, 8)
    held = set(zip(*(x.tolist() for x in tree.near_leaves(3))))
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 3).tolist():
            assert (min(i, j) // 8, max(i, j) // 8) in held
    assert len(held) < (len(v) // 8 + 1) ** 2 / 4


def test_simhash_texts(spark, prose):
    a, b = prose(2, 7, 300)
    edited = a.replace(a.split()[5], "changed", 1)
    rows = [(5, a), (3, edited), (9, a.upper()), (1, b), (2, None), (4, ""), (6, " \t"), (7, "one two"), (8, "one  TWO"), (1, b)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, fp int")
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert simhash.near_duplicates(df).count() == len(rows)
    fps = {i: simhash.fingerprint(simhash.shingle_hashes(t)) for i, t in rows}
    ids = sorted(fps)
    want = closed(len(ids), [(x, y) for x in range(len(ids)) for y in range(x) if (fps[ids[x]] ^ fps[ids[y]]).bit_count() <= 3])
    assert found == {i: (f"{fps[i]:016x}", ids[w]) for i, w in zip(ids, want)}
    assert found[2] == found[4] == found[6] == ("0" * 16, 2) and found[7][0] == found[8][0] and found[8][1] == 7
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_fingerprint_by_hand():
    h = simhash.shingle_hashes("A b  c d")
    want = [simhash.xxhash.xxh64_intdigest(x, 42) for x in (b"a b c", b"b c d")]
    assert h.tolist() == want and simhash.fingerprint(h) == want[0] & want[1]


def test_cap_filters_against_brute_force(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 64))
    near = np.concatenate([x[i] + r.normal(size=(12, 64)) * np.linalg.norm(x[i]) / 8 * s for i, s in ((0, 0.1), (1, 0.25), (2, 0.32), (3, 0.35))])
    x = np.concatenate([x, near, x[:3], x[:3] * 2]).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    rows += [(900, None, 0), (901, [0.0] * 64, 0), (902, [float("nan")] + [1.0] * 63, 0), (903, [None] + [1.0] * 63, 0), (904, [], 0), (905, [1.0, 2.0], 0), (906, [2.0, 4.0], 0), (907, [3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, filter int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T >= 0.95
    np.fill_diagonal(s, False)
    want = closed(len(x), list(zip(*np.nonzero(s))))
    for size in (8, 1024):
        found = {r["vec_id"]: r for r in cap_filters.near_duplicates(df, slice_rows=size).collect()}
        assert [found[i]["n_links"] for i in range(len(x))] == s.sum(1).tolist()
        assert [found[i]["component_id"] for i in range(len(x))] == want
        assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (900, 901, 902, 903, 904, 907))
        assert found[906]["component_id"] == 905 and found[905]["n_links"] == 1
    assert cap_filters.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize(("codewords", "pairs", "least"), [(256, 2000, 0.995), (1024, 800, 0.99), (4096, 400, 0.985)])
def test_cap_filter_recall_at_the_threshold(codewords, pairs, least):
    """Larger tables take more codewords; pairs at the threshold still share a filter."""
    r = np.random.default_rng(9)
    code = cap_filters.product_code(64, codewords)
    x = r.normal(size=(pairs, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = r.normal(size=x.shape)
    g -= (g * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    shared = [len(np.intersect1d(a, b)) for a, b in zip(code.decode(x), code.decode(y))]
    assert np.mean(np.array(shared) > 0) >= least


def test_list_decoding_finds_the_best_filters():
    code = cap_filters.ProductCode(10, 16, keep=12)
    x = np.random.default_rng(3).normal(size=(5, 10))
    z = x @ code.turn
    full = (z[:, :5] @ code.codes[0].T)[:, :, None] + (z[:, 5:] @ code.codes[1].T)[:, None, :]
    best = np.sort(np.argsort(-full.reshape(5, -1), axis=1)[:, :12], axis=1)
    assert np.array_equal(best, code.decode(x))


def test_line_dedup_against_sql(spark):
    r = random.Random(6)
    lines = ["a line that many hold", "  A LINE that many hold\t", "short", "", "another long line é", "x" * 12, "unique %d", "   "]
    rows = [(i, "\n".join((x % r.randrange(10**9) if "%" in x else x) for x in r.choices(lines, k=r.randint(0, 9)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n"), (73, "\n".join(["row %d of a long text" % (i % 900) for i in range(3000)])), (74, "row 5 of a long text\nrow 6 of a long text")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, keep string")
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(line_dedup.SQL).df().sort_values("doc_id").reset_index(drop=True)
    for parts in (1, 17):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = line_dedup.deduplicated(df.repartition(3)).toPandas().sort_values("doc_id").reset_index(drop=True)
        pd.testing.assert_frame_equal(found[want.columns], want, check_dtype=False)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert line_dedup.deduplicated(df.limit(0)).count() == 0


def test_line_dedup_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "the same long line"), (2, "the same long line"), (2, "the same long line\nthe same long line")], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"]) for r in line_dedup.deduplicated(df).collect())
    assert found == [(0, 1, 1), (2, 1, 0), (2, 2, 0)]

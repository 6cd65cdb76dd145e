"""Exact set-similarity joins by prefix filtering, and what is built on them.

Two sets whose Jaccard index is at least 4/5 have a first common token in any one order of tokens, and it stands so early
that what follows it suffices: in the larger set among its first n - ceil(4n/5) + 1, in the smaller among its first ninth.
Tokens go rarest first, by the counts of the most frequent ones, which every worker holds; any order gives the same pairs.
Rows of the larger and of the smaller part are joined on a token's hash and a class of sizes, pass a size, a positional and
a bitmap filter (each token of one set alone flips a bit at most), and the index is checked in integers on the tokens
themselves. Equal sets are joined as one set (copies cost nothing). Joins of tables that grow with the texts say that they
shuffle: their files are so small that Spark would take them for tables to broadcast. Ids are unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.functions.text import token_set
from quern.sources.scratch import materialised

_UP, _DOWN = fixed.NEAR


def near(a: Column, b: Column) -> Column:
    """Jaccard of two token arrays at least 4/5; an empty set is near nothing."""
    return (F.size(a) > 0) & (F.size(F.array_intersect(a, b)) * (_UP + _DOWN) >= (F.size(a) + F.size(b)) * _UP)


def token_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, tokens) of the rows with tokens; key is a digest of the set."""
    # a generator, as a filter on a column makes Spark work the column out twice
    sets = df.select(F.col(id_col).alias("id"), F.explode(F.array(token_set(F.col(text_col)))).alias("tokens")).filter(F.size("tokens") > 0)
    return sets.select("id", F.unhex(F.sha2(F.array_join("tokens", " "), 256)).alias("key"), "tokens")


def _firsts(sets: DataFrame) -> DataFrame:
    """(key, set_id): set_id is the least id that has these tokens."""
    return sets.groupBy("key").agg(F.min("id").alias("set_id"))


def _distinct_sets(sets: DataFrame) -> DataFrame:
    """(set_id, tokens): one row for each set of tokens."""
    first = _firsts(sets).select(F.col("set_id").alias("id"))
    return sets.select("id", "tokens").join(first, "id", "left_semi").withColumnRenamed("id", "set_id")


#: Tokens whose counts every worker holds (16 bytes each), the most frequent ones; the others come first, in no order of counts.
RANKED = 1 << 20
#: Tokens that are handled at a time.
_CHUNK = 1 << 18
#: The least sizes of the classes: each at least 5/4 of the one before, so a set at least 4/5 as large is in the same class or the one below.
_CLASSES = [1]
while _CLASSES[-1] < 1 << 40:
    _CLASSES.append(-(-_CLASSES[-1] * _DOWN // _UP))
_BITMAP = ("b0", "b1", "b2", "b3")


def _hashed(sets: DataFrame) -> DataFrame:
    return sets.select("set_id", F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))


def _ranked(*tables: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of the most frequent tokens, RANKED of them at most."""
    every = [t.select(F.explode("hashes").alias("h")) for t in tables]
    counts = materialised(reduce(DataFrame.unionAll, every).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"))
    log = F.floor(F.log2("n") * 8).cast("int")
    least, total = None, 0
    for r in sorted(counts.groupBy(log.alias("log")).count().collect(), key=lambda r: -r["log"]):
        total += r["count"]
        if total > RANKED:
            break
        least = r["log"]
    kept = counts.filter(F.lit(False) if least is None else log >= least).toArrow()
    h, n = kept["h"].to_numpy(), kept["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def _parts(sets: DataFrame, ranked: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(larger, key, set_id, n, place, bitmap) for each token of a set's prefix and each class of sizes that its partner may have: larger for the larger of two sets, else for the smaller."""
    known, counts = ranked
    classes = np.array(_CLASSES)
    kind = sets.schema["set_id"].dataType.simpleString()

    def chunk(ids: pa.Array, n: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        row = np.repeat(np.arange(len(n)), n)
        count = np.zeros(len(h), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            count = np.where(known[at] == h, counts[at], 0)
        h = h[np.lexsort((h, count, row))]
        first = np.cumsum(n) - n
        place = np.arange(1, len(h) + 1) - first[row]
        bits = np.bincount(row * 256 + (h & 255), minlength=len(n) * 256).astype(np.uint8) & 1
        bitmap = np.packbits(bits.reshape(len(n), 256), axis=1).view(np.int64)
        size = n[row]
        rest = size - place + 1
        most = np.minimum(((_UP + _DOWN) * rest - _UP * size) // _UP, size)
        least = -(-size * _UP // _DOWN)
        low, high = np.searchsorted(classes, least, "right"), np.searchsorted(classes, np.maximum(most, 1), "right")
        fits = most >= least
        small = (_UP + _DOWN) * rest >= 2 * _UP * size
        picks = [(True, np.flatnonzero(fits), low), (True, np.flatnonzero(fits & (high > low)), high), (False, np.flatnonzero(small), np.searchsorted(classes, size, "right"))]
        i = np.concatenate([x for _, x, _ in picks])
        of = row[i]
        with np.errstate(over="ignore"):
            key = h[i] * np.int64(-7046029254386353131) + np.concatenate([c[x] for _, x, c in picks]) * np.int64(-4417276706812531889)
        larger = np.concatenate([np.full(len(x), k) for k, x, _ in picks])
        return pa.RecordBatch.from_arrays([pa.array(larger), pa.array(key), ids.take(pa.array(of)), pa.array(size[i]), pa.array(place[i]), *(pa.array(bitmap[of, k]) for k in range(4))], ["larger", "key", "set_id", "n", "place", *_BITMAP])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, hashes = b.column(0), b.column(1)
            ends = hashes.offsets.to_numpy().astype(np.int64)
            values = hashes.values.to_numpy()
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + _CHUNK, "right")) - 1)
                yield chunk(ids.slice(i, j - i), np.diff(ends[i : j + 1]), values[ends[i] : ends[j]])
                i = j

    return sets.mapInArrow(run, f"larger boolean, key long, set_id {kind}, n long, place long, " + ", ".join(f"{b} long" for b in _BITMAP))


def _candidates(larger: DataFrame, smaller: DataFrame, tie: Column) -> DataFrame:
    """(x, y) of sets that pass the filters, x at least as large as y; tie: whether equal sizes count."""
    a = larger.filter("larger").select("key", F.col("set_id").alias("x"), F.col("n").alias("m"), F.col("place").alias("i"), *[F.col(b).alias(f"x{b}") for b in _BITMAP])
    b = smaller.filter("NOT larger").select("key", F.col("set_id").alias("y"), "n", F.col("place").alias("j"), *_BITMAP)
    both, every = F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j")) + 1, F.col("m") + F.col("n")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"x{b}").bitwiseXOR(F.col(b))) for b in _BITMAP])
    joined = a.join(b.hint("merge"), "key").filter((F.col("m") > F.col("n")) | (F.col("m") == F.col("n")) & tie)
    return joined.filter((F.col("n") * _DOWN >= F.col("m") * _UP) & (both * (_UP + _DOWN) >= every * _UP) & (apart * (_UP + _DOWN) <= every * (_DOWN - _UP))).select("x", "y")


def _set_pairs(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """(a, b) of near distinct sets: a < b within one table, or a of left and b of right."""
    tables = [_hashed(t) for t in ([left] if right is None else [left, right])]
    ranked = _ranked(*tables)
    parts = [materialised(_parts(t, ranked)) for t in tables]
    if right is None:
        found = _candidates(parts[0], parts[0], F.col("x") > F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    else:
        found = _candidates(parts[0], parts[1], F.lit(True)).select(F.col("x").alias("a"), F.col("y").alias("b"))
        found = found.unionAll(_candidates(parts[1], parts[0], F.lit(False)).select(F.col("y").alias("a"), F.col("x").alias("b")))
    return _checked(materialised(found.distinct()), left, left if right is None else right)


#: Pairs of a head that are checked together.
_TOGETHER = 20_000


def _checked(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are near.

    A set has a partner of its own as its head, so members of a group of near copies mostly have one head. Tokens of a go once
    to each head among its partners and not once to each partner; heads with many pairs are cut by b into slots.
    """
    heads = materialised(pairs.groupBy("b").agg(F.min("a").alias("head"), F.count("*").alias("n")))
    slots = heads.groupBy("head").agg(F.ceil(F.sum("n") / _TOGETHER).alias("slots"))
    ends = materialised(heads.join(slots, "head").select("b", "head", F.pmod(F.xxhash64("b"), F.col("slots")).alias("slot")))
    sent = materialised(pairs.join(ends.hint("merge"), "b").groupBy("a", "head", "slot").agg(F.collect_list("b").alias("partners")))

    def tokens(sets: DataFrame, ids: DataFrame, name: str, as_name: str) -> DataFrame:
        own = sets.join(ids.select(F.col(name).alias("set_id")).distinct(), "set_id", "left_semi")
        line = F.array_join("tokens", " ")  # no token holds a space, and a line is half as long as its array
        return ids.join(own.select(F.col("set_id").alias(name), line.alias(as_name)).hint("merge"), name)

    x, y = tokens(left, sent, "a", "x"), tokens(right, ends, "b", "y").hint("merge")
    together = x.join(y, ["head", "slot"]).filter(F.array_contains("partners", F.col("b")))
    return together.filter(near(F.split("x", " "), F.split("y", " "))).select("a", "b")


def near_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(a, b), a < b: representatives of near but different token sets; equal sets have one representative, see representatives."""
    return _set_pairs(materialised(_distinct_sets(materialised(token_sets(df, id_col, text_col)))))


def representatives(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, set_id): for each row with tokens, the least id with the same token set."""
    keys = materialised(token_sets(df, id_col, text_col).select("id", "key"))
    return keys.join(_firsts(keys), "key").select("id", "set_id")


def first_near(df: DataFrame, others: DataFrame, id_col: str, text_col: str, other_id: str, other_text: str) -> DataFrame:
    """(id, match): for each row, the least other_id of the rows near it; null for none."""
    sets, more = materialised(token_sets(df, id_col, text_col)), materialised(token_sets(others, other_id, other_text))
    pairs = _set_pairs(_distinct_sets(sets), _distinct_sets(more))
    best = pairs.groupBy(F.col("a").alias("set_id")).agg(F.min("b").alias("match"))
    found = sets.select("id", "key").join(_firsts(sets), "key").join(best, "set_id").select("id", "match")
    return df.select(F.col(id_col).alias("id")).join(found, "id", "left")


def greedy_kept(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kept): in order of id, a row is kept unless it is near a row kept before.

    The lexicographically first maximal independent set of the near graph, in rounds: undecided sets
    near a kept smaller one go; undecided sets with no undecided smaller neighbour stay. The smallest
    undecided set settles in every round, so rounds go on until none is left. Rows without
    tokens are kept; of equal sets only the first can be.
    """
    sets = materialised(token_sets(df, id_col, text_col))
    edges = materialised(_set_pairs(_distinct_sets(sets)))
    state = materialised(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("kept", F.lit(None).cast("boolean")))
    while not state.filter("kept IS NULL").isEmpty():
        smaller = edges.join(state.select(F.col("node").alias("a"), F.col("kept").alias("a_kept")), "a")
        seen = smaller.groupBy(F.col("b").alias("node")).agg(F.max(F.coalesce("a_kept", F.lit(False))).alias("beaten"), F.max(F.col("a_kept").isNull()).alias("waits"))
        now = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.coalesce("beaten", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        state = materialised(state.join(seen, "node", "left").select("node", now.alias("kept")))
    keys = sets.select("id", "key")
    judged = keys.join(_firsts(keys), "key").join(state, F.col("set_id") == F.col("node"), "left")
    verdict = judged.select("id", ((F.col("id") == F.col("set_id")) & F.coalesce("kept", F.lit(True))).alias("kept"))
    return df.select(F.col(id_col).alias("id")).join(verdict, "id", "left").select("id", F.coalesce("kept", F.lit(True)).alias("kept"))

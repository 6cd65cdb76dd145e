"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most three bits agree in one of four blocks of 16 bits, so each distinct
fingerprint goes, rotated, to a unit for each of its blocks: the unit is named by the block's first
bits, as many as make units of about UNIT fingerprints (16 at most). A unit is sorted by Gray rank, and
runs of LEAF fingerprints form the leaves of a binary tree whose nodes hold the bits that all
fingerprints below share (mask and pattern). A walk over pairs of nodes, from the root down, adds up the
differences in bits that both sides share and drops a pair of groups once they exceed the limit; only
leaves that are left are compared. Units beyond SLICE fingerprints are cut into slices by hash and
every pair of slices is a unit of its own, so no task holds an unbounded unit. Units return a spanning
forest of their links, never all pairs.

At a wide radius no block of bits agrees for certain. There (wide_links) a fingerprint has several words,
units are named by random bits of all of them, and as many tables of such units are made as a pair at the
radius needs to share one but with probability MISS; the trees compare first words, then all that go along.

Nulls and texts without words have fingerprint zero, which links like any other; a text of one or two
words is one shingle; rows with the same text share a fingerprint; an empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import with_labels, written
from quern.llm.components import components

SEED = 42
BLOCKS = 4
SLICE, UNIT, LEAF = 1024, 256, 4
#: Wide fingerprints: their words, those that go along with a row, fingerprints to aim for in a unit, and fingerprints in a leaf.
WIDE, ALONG, WIDE_UNIT, WIDE_LEAF = 8, 3, 1024, 16
MISS = 1e-4  # of pairs at the radius: no table in common; and each of both limits of bits
_ODD = np.random.default_rng(11).integers(0, 1 << 63, (3, WIDE, 1), np.uint64) | np.uint64(1)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 of every run of so many words, repeats included; fewer words: of the whole sequence; none: nothing."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return np.empty(0, "<u8")
    if len(w) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)], "<u8")
    h, join = xxhash.xxh64_intdigest, b" ".join
    return np.array([h(join(g), SEED) for g in zip(*(w[i:] for i in range(words)))], "<u8")


def fingerprint(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The bits set in over half of the hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), step):
        ones += np.unpackbits(hashes[i : i + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def wide_fingerprint(hashes: np.ndarray, step: int = 255) -> np.ndarray:
    """WIDE words, each from its own mix of the hashes; as in fingerprint, the bits set in over half of them."""
    ones, planes = np.zeros((8, WIDE, 8), np.int64), np.arange(8, dtype=np.uint64)[:, None, None]
    for i in range(0, len(hashes), step):
        x = (hashes[None, i : i + step] ^ _ODD[0]) * _ODD[1]
        x ^= x >> np.uint64(29)
        x *= _ODD[2]
        x ^= x >> np.uint64(32)
        counts = ((x >> planes) & np.uint64(0x0101010101010101)).sum(2, dtype=np.uint64)  # a byte counts to 255
        ones += counts.astype("<u8").view(np.uint8).reshape(8, WIDE, 8)
    return np.packbits(2 * ones.transpose(1, 2, 0).reshape(WIDE, 64) > len(hashes), axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): a signed long for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(x, words)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, "<u8").view("<i8"))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _find(parent: np.ndarray) -> np.ndarray:
    """Roots of all nodes; shortens the paths."""
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unites the classes of a[i] and b[i]; parent holds roots before and after."""
    for x, y in zip(a.tolist(), b.tolist()):
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
    return _find(parent)


class GrayTree:
    """A binary tree over fingerprints in Gray order; node i has children 2i+1 and 2i+2, leaves are runs of LEAF."""

    def __init__(self, values: np.ndarray, leaf: int = LEAF, more: np.ndarray | None = None, whole: int = 0) -> None:
        self.values, self.leaf = values, leaf
        self.more, self.whole = more, whole  # further words, and in how many places all words may differ
        runs = -(-len(values) // leaf)
        self.depth = max(0, (runs - 1).bit_length())
        starts = np.arange(runs) * leaf
        ones, union = np.bitwise_and.reduceat(values, starts), np.bitwise_or.reduceat(values, starts)
        self.levels = []  # from the leaves up: bits set in all, bits set in any
        for _ in range(self.depth + 1):
            self.levels.append((~(ones ^ union), ones))
            at = np.arange(0, len(ones), 2)
            ones, union = np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(union, at)

    def near_leaves(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves whose shared bits differ in at most limit places, found from the root down; dropped counts the pairs of groups left out above the leaves and at them."""
        self.dropped = []
        a = b = np.zeros(1, np.int64)
        for mask, pattern in self.levels[::-1]:
            if len(mask) > 1:
                a, b = (np.stack([2 * x + i for i in s]).ravel() for x, s in ((a, (0, 0, 1, 1)), (b, (0, 1, 0, 1))))
                keep = (a <= b) & (b < len(mask))
                a, b = a[keep], b[keep]
            keep = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= limit
            self.dropped.append(int(len(a) - keep.sum()))
            a, b = a[keep], b[keep]
        return a, b

    def forest(self, limit: int, step: int = 4096) -> np.ndarray:
        """For each fingerprint the first one of its component under links of at most limit bits."""
        n, own = len(self.values), np.arange(self.leaf)
        v = np.concatenate([self.values, np.zeros(-n % self.leaf, self.values.dtype)])
        parent, (i, j) = np.arange(n), self.near_leaves(limit)
        for k in range(0, len(i), step):
            x, y = (z[k : k + step, None] * self.leaf + own for z in (i, j))
            near = np.bitwise_count(v[x][:, :, None] ^ v[y][:, None, :]) <= limit
            near &= (x[:, :, None] < y[:, None, :]) & (y[:, None, :] < n)
            pair, p, q = np.nonzero(near)
            a, b = x[pair, p], y[pair, q]
            if self.more is not None:
                bits = np.bitwise_count(v[a] ^ v[b]).astype(np.int64)
                for word in self.more:
                    bits += np.bitwise_count(word[a] ^ word[b])
                a, b = a[bits <= self.whole], b[bits <= self.whole]
            parent = _joined(parent, a, b)
        return parent


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unites the classes of a[i] and b[i]; each turn takes one link of every class, so few turns replace a loop over all links."""
    while True:
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return parent
        _, one = np.unique(parent[a], return_index=True)
        parent = _unite(parent, parent[a[one]], parent[b[one]])


def _forest_edges(v: np.ndarray, unit: np.ndarray, rep: np.ndarray, limit: int, leaf: int = LEAF, more: list[np.ndarray] | None = None, whole: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links in whole units; v in Gray order within a unit; more and whole as in GrayTree."""
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    sizes = np.diff(np.r_[starts, len(unit)])
    parent = np.arange(len(v))
    for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        parent[s : s + n] = s + GrayTree(v[s : s + n], leaf, more and [w[s : s + n] for w in more], whole).forest(limit)
    moved = np.flatnonzero(parent != np.arange(len(v)))
    return rep[moved], rep[parent[moved]]


def links(reps: DataFrame, limit: int = 3, slice_rows: int = SLICE, unit_rows: int = UNIT) -> DataFrame:
    """(a, b): edges between representatives that together connect every pair of fingerprints within limit bits.

    reps: fp (distinct longs) and rep (the long that stands for it). limit is below the number of blocks.
    unit_rows: fingerprints to aim for in a unit.
    """
    if limit >= BLOCKS:
        raise ValueError("more differing bits than blocks less one need more blocks")
    width = 64 // BLOCKS
    bits = min(width, max(1, math.ceil(math.log2(max(1, reps.count()) / unit_rows + 1))))
    turned = [F.expr(f"(shiftleft(fp, {width * b}) | shiftrightunsigned(fp, {64 - width * b}))" if b else "fp") for b in range(BLOCKS)]
    rows = reps.select("rep", "fp", F.posexplode(F.array(*turned)).alias("block", "v")).withColumn("key", F.expr(f"shiftrightunsigned(v, {64 - bits})"))
    hot = rows.groupBy("block", "key").count().filter(F.col("count") > slice_rows).select("block", "key", F.ceil(F.col("count") / slice_rows).cast("long").alias("slices"))
    cut = rows.join(hot, ["block", "key"], "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("own", F.expr("pmod(xxhash64(fp), slices)"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    cut = cut.select("rep", "v", F.xxhash64("block", "key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"))
    gray = F.col("v")
    for k in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, k))
    cut = cut.withColumn("gray", gray).repartition("unit").sortWithinPartitions("unit", "gray").drop("gray")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rep, v in _whole_units(batches, 3):
            a, b = _forest_edges(v.view("<u8"), unit, rep, limit)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return cut.select("unit", "rep", "v").mapInArrow(run, "a long, b long")


def _whole_units(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """The columns of whole units, the first column, as many as a batch completes."""
    held = [np.empty(0, "<i8")] * columns
    for batch in _and_end(batches):
        if batch is not None:
            held = [np.concatenate([x, batch.column(k).to_numpy(zero_copy_only=False)]) for k, x in enumerate(held)]
            whole = np.searchsorted(held[0], held[0][-1])  # the last unit may go on
        else:
            whole = len(held[0])
        if whole:
            yield [x[:whole] for x in held]
            held = [x[whole:] for x in held]


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (b for b in batches if b.num_rows)
    yield None


def _least_limit(bits: int, rate: float) -> int:
    """The least number of differing bits that is exceeded with probability under MISS, if each differs at this rate."""
    left = 1.0
    for k in range(bits + 1):
        left -= math.comb(bits, k) * rate**k * (1 - rate) ** (bits - k)
        if left < MISS:
            return k
    return bits


def wide_links(reps: DataFrame, cosine: float, unit_rows: int = WIDE_UNIT, slice_rows: int = 2 * WIDE_UNIT) -> DataFrame:
    """(a, b): edges between representatives that together connect pairs of wide fingerprints whose hashes have at least this cosine.

    reps: rep (a long) and print (the bytes of a wide fingerprint). A bit of such a pair differs with
    probability arccos(cosine) / pi at most. Links are candidates: a pair is missed with probability of
    about three times MISS at the radius and less above it, and pairs somewhat beyond it are linked too.
    """
    rate = math.acos(cosine) / math.pi
    first, all_along = _least_limit(64, rate), _least_limit(64 * ALONG, rate)
    bits = max(1, math.ceil(math.log2(max(1, reps.count()) / unit_rows)))
    tables = math.ceil(math.log(MISS) / math.log1p(-((1 - rate) ** bits)))
    r = np.random.default_rng(13)
    places = np.concatenate([r.permutation(64 * WIDE) for _ in range(-(-tables * bits // (64 * WIDE)))])[: tables * bits].reshape(tables, bits)
    weights = np.int64(1) << np.arange(bits)

    def named(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The words of a batch's fingerprints with their units, table by table."""
        raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 8 * WIDE)
        own = np.unpackbits(raw, axis=1, bitorder="little")
        for t, at in enumerate(places):
            yield raw.view("<u8"), (t << 32) + own[:, at] @ weights

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _and_end(batches):
            if batch is not None:
                unit, n = np.unique(np.concatenate([u for _, u in named(batch)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(n)], names=["unit", "n"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _and_end(batches):
            if batch is not None:
                for words, unit in named(batch):
                    gray = words[:, 0].copy()
                    for k in (1, 2, 4, 8, 16, 32):
                        gray ^= gray >> np.uint64(k)
                    along = [pa.array(x.copy().view("<i8")) for x in (gray, *words.T[1:ALONG])]
                    yield pa.RecordBatch.from_arrays([pa.array(unit), batch.column(0), *along], names=["unit", "rep", "gray", *others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rep, gray, *more in _whole_units(batches, 2 + ALONG):
            v = gray.view("<u8") ^ (gray.view("<u8") >> np.uint64(1))
            a, b = _forest_edges(v, unit, rep, first, WIDE_LEAF, [x.view("<u8") for x in more], all_along)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    others = [f"w{k}" for k in range(1, ALONG)]
    rows = reps.select("rep", "print")
    hot = rows.mapInArrow(sizes, "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * slice_rows)
    hot = written(hot.select("unit", F.ceil(F.col("n") / slice_rows).cast("long").alias("slices")), "hot")
    cut = rows.mapInArrow(spread, "unit long, rep long, gray long, " + ", ".join(f"{w} long" for w in others)).join(hot, "unit", "left")
    cut = cut.withColumn("slices", F.coalesce("slices", F.lit(1).cast("long"))).withColumn("own", F.expr("pmod(xxhash64(rep), slices)"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    cut = cut.select(F.xxhash64("unit", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "rep", "gray", *others)
    return cut.repartition("unit").sortWithinPartitions("unit", "gray").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: 16 hex digits and the smallest doc_id reachable over links of at most limit bits.

    A null doc_id has its row too; it stands for its fingerprint only if no other row does.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "prints", texts=True)
    reps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_rows")), "reps")
    found = components(links(reps.filter("rep is not null"), limit))
    labelled = reps.join(found, reps["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"), "n_rows")
    return with_labels(prints, labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

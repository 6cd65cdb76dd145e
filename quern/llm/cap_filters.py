"""Embedding near-duplicates with spherical-cap filters from structured random product codes.

Vectors are rotated at random and cut into two blocks; a filter direction is a pair of random unit
codewords, one a block, so codewords ** 2 directions are held as 2 * codewords. A vector's threshold is
the value that LIST directions reach; list decoding finds all that exceed it from the two sorted block
scores without visiting the rest. Vectors join on filters; a pair is verified by its cosine in double
precision and counted only in the smallest filter that both hold. Equal vectors are one class with a
multiplicity; buckets beyond SLICE classes are cut into slices by hash, each pair of slices a unit, so
no task holds an unbounded bucket. Units return link counts and a spanning forest, never pairs.

Two vectors at cosine 0.95 share about half of their filters; the tests measure recall against brute
force. Vectors that are null, zero or hold null or non-finite components link with nothing, nor do
vectors of different lengths. Repeated vec_ids count as vectors of their own; an empty table gives no
rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import with_labels, written
from quern.llm.components import components
from quern.llm.simhash import _and_end, _unite

LIST, SLICE, SEED = 32, 1024, 90210


class ProductCode:
    def __init__(self, dim: int, codewords: int, keep: int = LIST) -> None:
        rng = np.random.default_rng([SEED, dim, codewords])
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.half = dim - dim // 2
        self.codes = []
        for size in (self.half, dim - self.half):
            words = rng.normal(size=(codewords, size)) if size else np.zeros((1, 0))
            self.codes.append(words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-12))
        self.codewords, self.keep = codewords, min(keep, codewords * len(self.codes[1]))
        ranks = [(i, j) for i in range(self.keep) for j in range(self.keep) if (i + 1) * (j + 1) <= self.keep and i < codewords and j < len(self.codes[1])]
        self.i, self.j = np.array(ranks).T

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The sorted filters that each unit vector exceeds its threshold for: (n, keep)."""
        z, best = x @ self.turn, []
        for block, words in zip((z[:, : self.half], z[:, self.half :]), self.codes):
            score = block @ words.T
            order = np.argsort(-score, axis=1, kind="stable")[:, : self.keep]
            best.append((order, np.take_along_axis(score, order, 1)))
        (a, u), (b, v) = best
        total = u[:, self.i] + v[:, self.j]  # a sum among the best has at most keep sums before it
        top = np.argsort(-total, axis=1, kind="stable")[:, : self.keep]
        return np.sort(np.take_along_axis(a[:, self.i] * self.codewords + b[:, self.j], top, 1), axis=1)


@lru_cache(maxsize=8)
def product_code(dim: int, codewords: int) -> ProductCode:
    return ProductCode(dim, codewords)


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cleaned(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, h, vec): the vector's doubles as bytes and their hash; both null for what links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = []
            for v in b.column(1).to_pylist():
                x = np.array([math.nan if c is None else c for c in v or ()], "<f8") + 0.0
                raw.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            h = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "h", "vec"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).mapInArrow(run, "vec_id long, h binary, vec binary")


def _filtered(classes: DataFrame, codewords: int) -> DataFrame:
    """A row for each class and filter that it exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).to_pylist()
            dims = np.array([len(r) // 8 for r in raw])
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                for at in np.array_split(own, -(-len(own) // 512)):
                    found = product_code(dim, codewords).decode(unit([raw[i] for i in at], dim))
                    again = pa.array(np.repeat(at, found.shape[1]))
                    yield pa.RecordBatch.from_arrays([*(c.take(again) for c in b.columns), pa.array(np.full(found.size, dim)), pa.array(found.ravel())], names=["rep", "vec", "mult", "dim", "filter"])

    return classes.select("rep", "vec", "mult").mapInArrow(run, "rep long, vec binary, mult long, dim long, filter long")


def _linked(x: np.ndarray, rep: np.ndarray, mult: np.ndarray, own: np.ndarray, filter_id: int, code: ProductCode, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In one unit: classes with the links that count here, and forest edges. own: the slice of each; only pairs across two slices count if there are two."""
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    if own[0] != own[-1]:
        near &= own[:, None] != own[None, :]
    at = np.flatnonzero(near.any(1))
    if not len(at):
        return (np.empty(0, np.int64),) * 4
    near, held = near[np.ix_(at, at)], code.decode(x[at])
    before = held < filter_id
    bits = np.zeros((len(at), max(1, len(seen := np.unique(held[before])))), np.float32)
    rows = np.nonzero(before)[0]
    bits[rows, np.searchsorted(seen, held[before])] = 1
    first = near & (bits @ bits.T == 0)
    parent = np.arange(len(at))
    while True:
        apart = near & (parent[:, None] != parent[None, :])
        rows = np.flatnonzero(apart.any(1))
        if not len(rows):
            break
        parent = _unite(parent, rows, apart[rows].argmax(1))
    moved = np.flatnonzero(parent != np.arange(len(at)))
    return rep[at], first @ mult[at], rep[at][moved], rep[at][parent[moved]]


def _links(classes: DataFrame, codewords: int, least: float, slice_rows: int) -> DataFrame:
    """(a, b, n): a class's links counted in a unit (b null), or a forest edge (n null)."""
    rows = _filtered(classes, codewords)
    hot = rows.groupBy("dim", "filter").count().filter(F.col("count") > slice_rows).select("dim", "filter", F.ceil(F.col("count") / slice_rows).cast("long").alias("slices"))
    cut = rows.join(hot, ["dim", "filter"], "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("own", F.expr("pmod(xxhash64(rep), slices)"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    cut = cut.select("rep", "vec", "mult", "dim", "filter", "own", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"))
    cut = cut.repartition("dim", "filter", "s", "t").sortWithinPartitions("dim", "filter", "s", "t", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in _and_end(batches):
            if batch is not None:
                held.append(batch)
                keys = [batch.column(k) for k in (3, 4, 6, 7)]
                if all(k[0] == k[-1] for k in keys):
                    continue  # one unit so far
            if not held:
                return
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = np.stack([rows.column(k).to_numpy() for k in (3, 4, 6, 7)])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
            ends = [*starts[1:].tolist(), rows.num_rows]
            if batch is not None:
                held, ends = [rows.slice(int(starts[-1]))], ends[:-1]
            out: list[list[np.ndarray]] = [[], [], [], []]
            for s, e in zip(starts.tolist(), ends):
                if e - s > 1:
                    part, dim = rows.slice(s, e - s), int(keys[0, s])
                    found = _linked(unit(part.column(1).to_pylist(), dim), part.column(0).to_numpy(), part.column(2).to_numpy(), part.column(5).to_numpy(), int(keys[1, s]), product_code(dim, codewords), least)
                    for o, f in zip(out, found):
                        o.append(f)
            a, n, u, v = (np.concatenate(o) if o else np.empty(0, np.int64) for o in out)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[a, u]), pa.array([None] * len(a) + v.tolist(), pa.int64()), pa.array(n.tolist() + [None] * len(u), pa.int64())], names=["a", "b", "n"])

    return cut.mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, codewords: int | None = None, slice_rows: int = SLICE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    A row with a null vec_id counts as a copy of equal vectors; where no equal vector has an id, it links
    only with its copies and has no component.

    codewords a block; default: the power of two next to the square root of the number of rows, 256 at
    least, so that buckets keep their size as tables grow.
    """
    rows = written(_cleaned(vectors, id_col, vec_col), "vectors")
    classes = written(rows.filter("h is not null").groupBy("h", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "classes")
    if codewords is None:
        codewords = max(256, 1 << math.ceil(math.log2(max(1, classes.count())) / 2))
    found = written(_links(classes.filter("rep is not null"), codewords, least, slice_rows), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts = components(found.filter("b is not null").select("a", "b"))
    labelled = classes.join(counts, "rep", "left").join(parts, classes["rep"] == parts["node"], "left")
    labelled = labelled.select("h", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), F.col("mult").alias("n_rows"))
    out = with_labels(rows.select("vec_id", "h"), labelled, "h")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a AS node, a AS seen FROM links
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a
), parts AS (
  SELECT node, min(seen) AS component FROM reach GROUP BY node
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id,
  e.vec_id = coalesce(component, e.vec_id) AS kept
FROM embeddings AS e LEFT JOIN counts ON e.vec_id = counts.a LEFT JOIN parts ON e.vec_id = parts.node
"""

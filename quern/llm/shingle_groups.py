"""Near-duplicate groups by five-word shingles: SimHash in a Gray-order index for candidates, exact similarity for links.

Rows with equal sets of shingles are one node, so copies cost nothing. A node's fingerprint has eight words
of bits. Two sets with a Jaccard index of 0.8 have a cosine of 8/9 at least, so their bits differ at a rate of 0.151 at most: the
index finds nodes within that radius (simhash.wide_links), and misses a pair at 0.8 with probability of about 3e-4, less above it.
Sets of fewer than four shingles have no others at 0.8 and take no part. Components of these links are clusters; in a cluster
every pair is open to an exact check, and links of at least SIMILARITY are kept as a spanning forest.
Clusters whose texts go beyond SLICE bytes or SLICE_ROWS nodes are cut into slices by hash and every
pair of slices is a unit of its own. Groups are the components of the checked links.

Words are split at white space, ASCII letters in lower case; a text of fewer than five words is one
shingle; texts without words are equal. A fingerprint of 64 bits can't give such candidates: at 0.8 it
differs in about ten bits, which no split into blocks finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, same_text, written
from quern.llm.components import components
from quern.llm.simhash import shingle_hashes, wide_fingerprint, wide_links

WORDS, UP, DOWN = 5, 4, 5  # similarity of at least UP / DOWN
COSINE = 2 * UP / (UP + DOWN)  # of two sets at that similarity, at least
SLICE, SLICE_ROWS = 2 << 20, 512


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of the runs of five words, ascending."""
    return np.unique(shingle_hashes(text, WORDS))


def node_of(own: np.ndarray) -> int:
    """A signed long that stands for the set."""
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64))


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, same, node, print) for every row; no fingerprint for sets that only equal ones are near to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                nodes, found = [], []
                for text in batch.column(2).to_pylist():
                    own = shingles(text)
                    nodes.append(node_of(own))
                    found.append(wide_fingerprint(own).tobytes() if len(own) >= UP else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "same", "node", "print"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), same_text(text_col).alias("same"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, same long, node long, print binary")


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of places that span the components of all links of at least UP / DOWN; sets are not empty."""
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    held, group, found = np.zeros(len(names), np.int64), np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        fits = (group != group[i]) & (UP * np.maximum(sizes, sizes[i]) <= DOWN * np.minimum(sizes, sizes[i]))
        fits[: i + 1] = False
        if not fits.any():
            continue
        own = flat[starts[i] : starts[i] + sizes[i]]
        held[own] = 1
        both = np.add.reduceat(held[flat], starts)
        held[own] = 0
        for j in np.flatnonzero(fits & (DOWN * both >= UP * (sizes + sizes[i] - both))).tolist():
            if group[i] != group[j]:
                found.append((i, j))
                group[group == group[j]] = group[i]
    return found


def _checked(rows: DataFrame) -> DataFrame:
    """(a, b): forests of the checked links in each unit of rows (unit, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, {}

        def linked() -> pa.RecordBatch:
            nodes = list(held)
            pairs = forest(list(held.values())) if len(nodes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[k[s]] for k in pairs], pa.int64()) for s in (0, 1)], names=["a", "b"])

        for batch in batches:
            for u, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    yield linked()
                    unit, held = u, {}
                held[node] = shingles(text)
        yield linked()

    return rows.repartition("unit").sortWithinPartitions("unit").select("unit", "node", "text").mapInArrow(run, "a long, b long")


def _units(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(unit, node, text) of the clusters' nodes: a cluster, or a pair of its slices."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), same_text(text_col).alias("of"), F.col(text_col).cast("string").alias("text"))
    rows = written(text.join(members, text["id"].eqNullSafe(members["doc_id"]) & (text["of"] == members["same"])).select("cluster", "node", "text"), "members")
    total = rows.groupBy("cluster").agg(F.sum(F.octet_length("text").cast("long")).alias("n"), F.count("*").alias("c"))
    hot = total.filter((F.col("n") > most) | (F.col("c") > SLICE_ROWS)).select("cluster", F.ceil(F.greatest(F.col("n") / most, F.col("c") / SLICE_ROWS)).cast("long").alias("slices"))
    cut = rows.join(hot, "cluster", "left").withColumn("slices", F.coalesce("slices", F.lit(1).cast("long"))).withColumn("own", F.expr("pmod(xxhash64(node), slices)"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    return cut.select(F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "node", "text")


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SLICE) -> DataFrame:
    """(doc_id, same) of the first row of each group, by doc_id, null after all others, and then by the hash of the text."""
    prints = written(_prints(docs, id_col, text_col), "prints", texts=True)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    nodes = written(prints.groupBy("node").agg(F.min(order).alias("first"), F.min("print").alias("print")), "nodes")
    found = components(wide_links(nodes.filter("print is not null").select(F.col("node").alias("rep"), "print"), COSINE))
    nodes = nodes.drop("print")
    clusters = written(found.select("node", F.col("component").alias("cluster")).unionAll(found.select(F.col("component").alias("node"), F.col("component").alias("cluster")).distinct()), "clusters")
    members = nodes.join(clusters, "node").select("node", "cluster", "first.doc_id", "first.same")
    groups = components(_checked(_units(docs, members, id_col, text_col, most))).withColumnRenamed("node", "member")
    named = nodes.join(groups, nodes["node"] == groups["member"], "left").select(F.coalesce("component", "node").alias("g"), "first")
    return named.groupBy("g").agg(F.min("first").alias("first")).select("first.doc_id", "first.same")

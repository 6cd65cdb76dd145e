"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest member of the node's closed neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): for each node but the smallest of its component, the smallest node that it reaches.

    edges: two columns of longs, undirected, repeats and loops allowed. Alternates large-star and
    small-star steps (Kiveris et al., SoCC 2014) until every node hangs on its component's smallest
    node; each round is written to the shared folder. No edges: an empty table.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).filter("a != b").distinct()
    now, before = written(now, "edges"), None
    for _ in range(rounds):
        now = written(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
    raise RuntimeError(f"components have not settled after {rounds} rounds")

"""Connected components of an edge table by alternating star contraction.

Each round replaces edges by edges to the smallest neighbour (first for larger neighbours, then for
smaller ones) until the edges are stars around each component's smallest node. The minimum per node is
partially aggregated and joined back on the node, so a node with very many edges is a skewed key that
adaptive execution splits; no neighbour list is gathered. Each round is written under the shared
checkpoint folder. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b): the smallest node reachable."""
    now = pin(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b").distinct())
    state = None
    for _ in range(max_rounds):
        now = pin(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        state = tuple(seen)
    raise RuntimeError("components did not settle")

"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabulens.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Works on any number of edges; only a count and a checksum per round reach the driver. The rounds grow with the logarithm of the
    longest path. The largest neighbourhood is read from an aggregate and joined back, so a hub is split by the skew join.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, seen = staged(current, "edges"), None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
        seen = mark
        current = staged(_small_star(_large_star(current)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()

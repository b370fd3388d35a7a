"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrove.operators.scale import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them.

    ``edges`` has ``a < b``: the smaller neighbours of ``b`` are its ``a``.
    """
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has a link; the root is the smallest node it reaches.

    ``edges`` holds links ``(a, b)`` of comparable values; direction, repeats, nulls and links of
    a node to itself do not matter. Large-star and small-star rounds alternate until the edges are
    stars, O(log^2 n) rounds in the worst case. A node's minimum is aggregated map-side and joined
    back, so that a hub is a large side of a join, which adaptive execution splits, and never one
    group in one task. Each round is written to the shared folder; the lineage stays one round long.
    """
    edges = settle(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    state, before = _state(edges), None
    while state != before and state[0]:
        edges = settle(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        before, state = state, _state(edges)
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)

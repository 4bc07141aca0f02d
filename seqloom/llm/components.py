"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node points to one node, which points nowhere."""
    side = lambda c: F.struct(F.col(c).alias("node"), F.lit(int(c == "a")).alias("out"), F.lit(int(c == "b")).alias("into"))
    ends = edges.select(F.inline(F.array(side("a"), side("b"))))
    told = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return told.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round points every node to the smallest of its neighbours and itself and then points the
    smaller neighbours to that one, which keeps components whole and halves their depth. Rounds
    stop when every component is a star around its smallest node. Labels are aggregates joined back, so a node
    with very many neighbours is pre-aggregated and its join is split by adaptive execution.
    Nodes are numbers. An empty table of edges gives an empty result.
    """
    edges = scratch.cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        # every larger neighbour of a node moves to the node's smallest neighbour
        around = _both_ways(edges)
        low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = around.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # the smaller neighbours of a node and the node itself move to the smallest of them
        low = moved.groupBy("a").agg(F.min("b").alias("low"))
        hooked = moved.join(low, "a")
        moved = hooked.select(F.inline(F.array(*[F.struct(F.col(c).alias("a"), F.col("low").alias("b")) for c in "ab"])))
        last, edges = edges, scratch.cut(moved.filter("a <> b").distinct())
        scratch.drop(last)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)

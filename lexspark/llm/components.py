"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes that have an edge to another one; ``edges`` has ``a``, ``b``.

    The component is its least node. Alternating stars bring every component to one star around its
    least node in a number of rounds that grows with the logarithm of its size; each round is
    written to the shared folder, which also cuts the lineage. No component is ever gathered in one task: a
    large star is a set of rows.
    """
    current = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        found = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if (found["n"], found["h"]) == state or not found["n"]:
            break
        state = (found["n"], found["h"])
        current = materialise(_small_star(_large_star(current)), "edges")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

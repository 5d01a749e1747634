"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node links its larger neighbours (large), or itself and its smaller ones (small), to the least node around."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (a, b).

    Each round is written to the shared folder, so that a lost executor repeats one round at most. Neighbours of a node
    are only ever reduced to their minimum, so a node with very many is not gathered in one place.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now, before = materialise(now, "edges"), None
    while True:
        now = materialise(_star(_star(now, large=True), large=False), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if state == before:
            ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state

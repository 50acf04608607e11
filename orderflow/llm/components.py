"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved


def _least(edges: DataFrame) -> DataFrame:
    """For each left node, the smallest node that it or a partner is."""
    return edges.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))


def _step(edges: DataFrame, both_ways: bool) -> DataFrame:
    if both_ways:
        # Every larger partner moves to the smallest.
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = sides.join(_least(sides), "a").where("b > a").select(F.col("b").alias("a"), "low")
    else:
        # Smaller partners, and the node itself, move to the smallest.
        low = _least(edges)
        rest = edges.join(low, "a").select(F.col("b").alias("a"), "low")
        moved = rest.unionByName(low)
    return moved.where("a <> low").select("a", F.col("low").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every node of ``a``-``b`` edges.

    Edges may repeat, point either way or be loops; a node with loops only is
    left out, as is one with a null end.  Each round is a table in the shared
    folder.  Steps keep what is connected so, and point to smaller nodes; rounds end
    when edges form stars: every left node has one edge, and none is a right node.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = saved(edges.distinct(), "component", narrow=True)
    while True:
        roles = edges.select(F.col("a").alias("id"), F.lit(1).alias("left")).unionByName(
            edges.select(F.col("b").alias("id"), F.lit(0).alias("left"))
        )
        roles = roles.groupBy("id").agg(
            F.sum("left").alias("lefts"), F.min("left").alias("least")
        )
        # More than one edge as left node, or left and right node at once.
        if roles.where("lefts > 1 or lefts = 1 and least = 0").isEmpty():
            break
        edges = saved(_step(_step(edges, True), False), "component", narrow=True)
    heads = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        heads.withColumn("component", F.col("id"))
    )


def nearby(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``: the least node within two edges, or close to that.

    Nodes with one component are connected, but connected nodes may have several.
    Members of a star have one.
    """
    sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _least(sides)
    far = sides.join(low.select(F.col("a").alias("b"), "low"), "b")
    far = far.groupBy(F.col("a").alias("id")).agg(F.min("low").alias("component"))
    return far

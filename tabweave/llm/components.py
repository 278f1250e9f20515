"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.storage import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, comparable); the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then its
    smaller neighbours. Groups are only aggregated, never gathered; the joins are equi-joins that adaptive
    execution splits at a hub. The number of rounds grows with the logarithm of the longest chain. Each round is
    written to the shared folder.
    """
    current = stage(_canonical(edges), "components")
    while True:
        large = _step(current, larger=True)
        following = stage(_step(large, larger=False), "components")
        difference = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        before = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current = following
        if difference == before:
            break
    roots = current.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)


def _canonical(edges: DataFrame) -> DataFrame:
    """Each link once, from the smaller node ``a`` to the larger node ``b``."""
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _step(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node, and itself, to its smallest neighbour."""
    if larger:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    # Written, so that the join reads plain exchanges and a hub can be split.
    least = stage(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "components-least")
    linked = near.join(least, "u")
    moved = linked.where("v > u") if larger else linked.where("v != m")
    ends = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not larger:
        ends = ends.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return _canonical(ends)

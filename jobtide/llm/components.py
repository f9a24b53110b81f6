"""Connected components of links between 64-bit nodes, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_least(arcs: DataFrame, upward: bool) -> DataFrame:
    """Point neighbours of each node at the least node near it: the larger neighbours only (``upward``), or the smaller ones
    and the node itself. ``arcs`` leads from each node to those neighbours."""
    least = arcs.groupBy("a").agg(F.min("b").alias("least"))
    near = stored(least.select("a", F.least("a", "least").alias("least")), "component-least")
    moved = arcs.join(near, "a")
    if upward:
        pairs = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        pairs = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(near.select("a", F.col("least").alias("b")))
    return pairs.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node that occurs in ``links`` (``a``, ``b``).

    Links may repeat, run either way or join a node to itself (which gives no row by itself). Each round points nodes at
    the least node around them, so path lengths at least halve in effect; it ends when all that is left are stars.
    Aggregates are pre-summed and joins are between stored tables, so a node with very many links is split.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links")
    while True:
        large = stored(_to_least(_both_ways(now), upward=True), "component-links")
        now = stored(_to_least(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), upward=False), "component-links")
        # Done when all that is left are stars: each node has one link down, to a node without any.
        forked = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
        chained = now.join(now.select(F.col("b").alias("root")).distinct(), F.col("a") == F.col("root"), "left_semi").select("a")
        if forked.union(chained).isEmpty():
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

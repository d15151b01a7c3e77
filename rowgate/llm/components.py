"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, area: StagingArea, name: str) -> DataFrame:
    """``node, component`` of every node with an edge to another one; the least node names it.

    ``edges`` has two columns ``u`` and ``v`` of numbers. Every round is written, so lost
    executors cost a re-read. What comes to the driver is a checksum per round. A node with very
    many edges is combined before the shuffle, and its rows in a join are split.
    """
    def settled(df: DataFrame) -> DataFrame:
        return df.where("u <> v").distinct()

    current = area.stage(settled(edges.select("u", "v")), f"{name}-0")
    before = None
    step = 0
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            )
        before, step = state, step + 1
        current = area.stage(settled(_small_star(settled(_large_star(current)))), f"{name}-{step}")

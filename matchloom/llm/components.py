"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _neighbours_min(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge in both directions, with u's least neighbour or itself.

    The least neighbour is a partial aggregate, so a node with very many edges is summed
    up before the shuffle, and the join that follows may be split where it is skewed.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "node")
    return both.join(least, F.col("u") == F.col("node")).drop("node")


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node links to the node's least neighbour."""
    return _neighbours_min(edges).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, link to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node")
    linked = down.join(least, F.col("u") == F.col("node"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node with an edge. edges: (u, v), longs.

    Each round is written to the shared folder, and ends when the edges no longer change:
    then they are stars around the least nodes. Rounds grow with the logarithm of the size.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _fingerprint(now)
    while True:
        now = stored(small_star(large_star(now)))
        new = _fingerprint(now)
        if new == state:
            break
        state = new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and two sums of hashes: equal for equal edge sets."""
    h, g = F.xxhash64("u", "v"), F.xxhash64("v", "u")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.sum(g.cast("decimal(38,0)"))).first())

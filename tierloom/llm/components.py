"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.sources.storage import materialize


def _least(links: DataFrame) -> DataFrame:
    """(u, least) of each node: its smallest neighbour or itself; written, so that joins with it can split hot nodes."""
    return materialize(links.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are tied to the smallest node around it."""
    links = edges.union(edges.select("v", "u").toDF("u", "v"))
    return links.join(_least(links), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are tied to the smallest of them."""
    links = edges.where("u > v")
    least = _least(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.toDF("u", "v")).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long); the root is the smallest node it reaches.

    Each round is two grouped minima and two joins on tables as large as the
    edges at most; the rounds grow with the logarithm of the longest chain.
    Only counts of edges come to the driver.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        after = materialize(_small_star(_large_star(now)).distinct())
        same = after.count() == now.count() and after.join(now, ["u", "v"], "left_anti").isEmpty()
        now = after
        if same:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(now.select("v", "v").distinct().toDF("node", "root"))

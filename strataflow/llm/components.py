"""Connected components of links, by contraction on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def components(edges: DataFrame, staging: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v`` long); ``root`` is the smallest id reachable.

    Each round hooks every node to its smallest neighbour, follows the hooks twice and keeps one edge
    between the nodes that remain, so the edges shrink geometrically. Minima are combined before they
    are shuffled: a node with a third of all edges is no hot spot.
    """
    left = staged(edges.where("u <> v").select("u", "v").distinct(), staging)
    labels = left.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = ends.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("up"))
        hooks = staged(hooks, staging)
        for _ in range(2):
            above = hooks.select(F.col("u").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(above, "up").select("u", F.col("top").alias("up"))
        hooks = staged(hooks, staging)
        for end in ("u", "v"):
            left = left.join(hooks.withColumnsRenamed({"u": end, "up": "_to"}), end).drop(end).withColumnRenamed("_to", end)
        left = staged(left.where("u <> v").distinct(), staging)
        labels = labels.join(hooks.withColumnRenamed("u", "root"), "root", "left")
        labels = staged(labels.select("node", F.coalesce("up", "root").alias("root")), staging)
    return labels


def joined_up(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node, root``) after more ``links`` (``u, v``); nodes without a label are their own root."""
    roots = between(labels, links).select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
    merged = components(roots).select(F.col("node").alias("root"), F.col("root").alias("to"))
    fresh = links.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(fresh.withColumn("root", F.col("node")))
    return staged(
        every.join(merged, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
    )


def between(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The ``links`` whose ends have different roots, with ``root_u, root_v``."""
    for end in ("u", "v"):
        links = links.join(labels.withColumnsRenamed({"node": end, "root": f"root_{end}"}), end, "left")
        links = links.withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return links.where("root_u <> root_v")

"""Subtree sums of a forest by centroid decomposition.

Nodes are named by ``(path, depth)``: the path is the least of those that run through the node. ``paths`` has
for each path and depth the node there (``node``, its path) and the one above (``above``). The weight of a node
is the number of paths through it, so the weight of a whole subtree is known from the start: for each path
through the top the nodes from there on.

Each round takes from every component its centroid, the deepest node below which (itself included) lies at least
half of the weight. What hangs below each of its children, and what is left above, are the components of the next
round, none with more than half the weight; so there are at most 1 + log2(paths x depth) rounds, however deep or
broad the tree. The total of what lay below the centroid is added to all nodes on the way from it to the
component's top. Any node and any descendant of it are so added up once: in the round that parts them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """``path, depth`` and each of ``values`` summed over the subtree of the node, the node included.

    ``nodes`` has ``path, depth, weight`` (of the subtree), ``top`` (path of the tree's top, which has depth 0) and
    the values (long, not null). ``paths`` has ``path, depth, node, above``. Both are staged. No nodes give no rows.
    """
    at = nodes.select(
        "path", "depth", "weight", F.col("top").alias("piece"), F.lit(0).cast("long").alias("piece_depth"),
        F.lit(False).alias("centroid"), *values,
    )
    added: list[DataFrame] = []
    ways = paths.select(F.col("path").alias("_path"), F.col("depth").alias("_depth"), "node", "above")
    while True:
        # Each component has its top as the name; the weight of the top is that of the component.
        left = at.where("NOT centroid").drop("centroid")
        tops = left.where("path = piece AND depth = piece_depth").select("piece", "piece_depth", F.col("weight").alias("whole"))
        active = left.join(tops, ["piece", "piece_depth"])
        heavy = active.where("2 * weight >= whole").groupBy("piece", "piece_depth")
        cut = heavy.agg(F.max(F.struct("depth", "path", "weight")).alias("c"))
        cut = cut.select("piece", "piece_depth", *[F.col(f"c.{name}").alias(f"c_{name}") for name in ("depth", "path", "weight")])
        below = F.col("depth") > F.col("c_depth")
        # Below the centroid's depth: which of its children is on the way. From it upwards: who is on its way.
        seen = active.join(cut, ["piece", "piece_depth"]).withColumns({
            "_path": F.when(below, F.col("path")).otherwise(F.col("c_path")),
            "_depth": F.when(below, F.col("c_depth") + 1).otherwise(F.col("depth")),
        }).join(ways, ["_path", "_depth"])
        centroid = (F.col("depth") == F.col("c_depth")) & (F.col("path") == F.col("c_path"))
        under = below & F.col("above").eqNullSafe(F.col("c_path"))
        on_way = ~below & (F.col("node") == F.col("path"))
        at = seen.select(
            "path", "depth",
            F.when(on_way, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            F.when(under, F.col("node")).otherwise(F.col("piece")).alias("piece"),
            F.when(under, F.col("c_depth") + 1).otherwise(F.col("piece_depth")).alias("piece_depth"),
            centroid.alias("centroid"),
            F.col("piece").alias("old"), F.col("piece_depth").alias("old_depth"),
            (under | centroid).alias("summed"), on_way.alias("on_way"), *values,
        )
        at = staged(at, "centroids")
        totals = at.where("summed").groupBy("old", "old_depth").agg(*[F.sum(value).alias(value) for value in values])
        added.append(at.where("on_way").select("path", "depth", "old", "old_depth").join(totals, ["old", "old_depth"]))
        at = at.drop("old", "old_depth", "summed", "on_way")
        if at.where("NOT centroid").isEmpty():
            break
    every = reduce(DataFrame.unionByName, added)
    return every.groupBy("path", "depth").agg(*[F.sum(value).alias(value) for value in values])

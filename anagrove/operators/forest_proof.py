"""What a fitted forest's splits are worth, recomputed from rows sent through its trees.

The trees are read from the model's own saved form, as rows. Data rows go down all trees
at once, level by level, and are counted in every node they pass; from these counts come
the impurity of each node and how much its split lowers it. Nothing of what the fit says
about its counts is used, so both can be held against each other.

Nodes are broadcast: their number is bounded by trees and depth, and checked. Rows with
null features or labels take no part. A tree of one leaf has no split and gives no row.
"""

from __future__ import annotations

from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.session import scratch_path

# Nodes that are sent to every executor, at some 50 bytes each.
MAX_NODES = 2_000_000


def forest_nodes(spark: SparkSession, model: Any) -> DataFrame:
    """Every node of a forest: ``tree``, ``node``, its children (-1 in a leaf), feature and threshold.

    ``fitted_gain`` is the decrease that the fit has noted.
    """
    path = scratch_path(spark, "forest")
    model.save(path)
    held = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    return held.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["split"]["numCategories"].alias("categories"),
        node["gain"].alias("fitted_gain"),
    )


def node_counts(rows: DataFrame, nodes: DataFrame, depth: int, weight: str | None = None) -> DataFrame:
    """Rows and weight of both classes (label 0 and 1) in every node that rows pass.

    Splits on continuous features only; others stop the job.
    """
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("left") >= 0) & (F.col("categories") >= 0)).alias("c")).first()
    if size.n > MAX_NODES or size.c:
        raise ValueError(f"{size.n} nodes, {size.c} of them with categories: not supported")
    trees = F.array(*[F.lit(r.tree) for r in nodes.select("tree").distinct().orderBy("tree").collect()])
    at = (
        rows.filter(F.col("features").isNotNull() & F.col("label").isNotNull())
        .select(
            vector_to_array("features").alias("_x"),
            F.col("label").cast("double").alias("_y"),
            (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"),
            F.explode(trees).alias("tree"),
        )
        .select("*", F.lit(0).alias("node"), F.array(F.lit(0)).alias("_path"))
    )
    inner = F.broadcast(nodes.filter(F.col("left") >= 0).select("tree", "node", "left", "right", "feature", "threshold"))
    for _ in range(depth):
        below = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        moved = at.join(inner, ["tree", "node"], "left").select(
            "_x", "_y", "_w", "tree", F.when(F.col("left").isNotNull(), below).alias("_next"), "node", "_path"
        )
        at = moved.select(
            "_x",
            "_y",
            "_w",
            "tree",
            F.coalesce("_next", "node").alias("node"),
            F.when(F.col("_next").isNotNull(), F.concat("_path", F.array("_next"))).otherwise(F.col("_path")).alias("_path"),
        )
    passed = at.select("tree", F.explode("_path").alias("node"), "_y", "_w")
    return passed.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("_y") == 0, F.col("_w")).otherwise(0.0)).alias("w0"),
        F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0.0)).alias("w1"),
    )


def split_gains(rows: DataFrame, nodes: DataFrame, depth: int, weight: str | None = None) -> DataFrame:
    """Per split that rows reach: rows, impurity of the node, and the decrease, next to ``fitted_gain``.

    The two decreases are equal for a forest fitted on the same rows without resampling.
    A child that no row reaches weighs nothing.
    """
    counts = node_counts(rows, nodes, depth, weight)
    total = F.col("w0") + F.col("w1")
    gini = F.coalesce(2 * F.try_divide(F.col("w0"), total) * F.try_divide(F.col("w1"), total), F.lit(0.0))
    worth = counts.select("tree", "node", "n", total.alias("w"), gini.alias("impurity"))
    splits = nodes.filter(F.col("left") >= 0).select("tree", "node", "left", "right", "fitted_gain").join(worth, ["tree", "node"])

    def child(side: str) -> DataFrame:
        return worth.select("tree", F.col("node").alias(side), F.col("w").alias(f"_w_{side}"), F.col("impurity").alias(f"_i_{side}"))

    both = splits.join(child("left"), ["tree", "left"], "left").join(child("right"), ["tree", "right"], "left")
    kept = sum((F.coalesce(F.col(f"_w_{s}") * F.col(f"_i_{s}"), F.lit(0.0)) for s in ("left", "right")), F.lit(0.0))
    return both.select(
        "tree", "node", "n", "impurity", (F.col("impurity") - F.coalesce(F.try_divide(kept, F.col("w")), F.lit(0.0))).alias("gain"), "fitted_gain"
    )

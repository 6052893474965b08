"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = smallest node reachable.

    Each round hooks the root of a label's tree to the smallest label seen across any edge and then
    jumps pointers, so long chains shrink geometrically. A hub only ever meets aggregates, which are
    combined map-side. Every round is a table in the shared scratch folder.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = written(spark, both, "cc-edges")
    labels = written(spark, both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component"))
                     .select(F.col("a").alias("node"), "component"), "cc-labels")
    while True:
        la = labels.select(F.col("node").alias("a"), F.col("component").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("component").alias("lb"))
        seen = both.join(lb, "b").join(la, "a")
        # the smallest label next to any member of a tree moves the tree's root
        hook = seen.where("lb < la").groupBy(F.col("la").alias("root")).agg(F.min("lb").alias("to"))
        hook = written(spark, hook, "cc-hook")
        if hook.isEmpty():
            return labels
        jumped = labels.join(hook, labels.component == hook.root, "left").select(
            "node", F.coalesce("to", "component").alias("component"))
        jumped = written(spark, jumped, "cc-labels")
        parent = jumped.select(F.col("node").alias("p"), F.col("component").alias("pc"))
        labels = written(spark, jumped.join(parent, jumped.component == parent.p).select(
            "node", F.least("component", "pc").alias("component")), "cc-labels")

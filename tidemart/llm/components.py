"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sources.staging import Staging


def components(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of every node of the links
    ``(a, b)``, two numbers each. Nodes without a link don't appear; no link gives no row.

    Every round takes the least label among the neighbours and then the label of that label,
    so that chains shrink by half or better; it ends when a round changes nothing. A round is
    a written table, so a lost executor costs one round at most.
    """
    ways = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staging.settle(ways.where("a <> b").distinct(), f"{name}_edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = labels.select("node", F.least("node", "label").alias("label"))
    labels = staging.settle(labels, f"{name}_0")
    step = 0
    while True:
        step += 1
        near = edges.join(labels, edges.b == labels.node)
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        lower = staging.settle(lower, f"{name}_{step}_near")
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = lower.join(target, "label").select(
            "node", "was", F.least("label", "far").alias("label")
        )
        jumped = staging.settle(jumped, f"{name}_{step}")
        labels = jumped.select("node", "label")
        if jumped.where("label <> was").isEmpty():
            return labels.withColumnRenamed("label", "component")

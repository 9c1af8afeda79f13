"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.tables import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b).

    The component is the smallest node reachable.  Each round takes the
    smallest label among a node's neighbours and then the label of that
    label, so the rounds grow with the logarithm of the longest chain.  No
    node's neighbours are gathered: labels are minima of joined rows.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("component")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        step = cut(step.join(jump, "component").select(
            "node", "before", F.least("component", "beyond").alias("component")))
        labels = step.select("node", "component")
        if step.where("component < before").isEmpty():
            return labels

"""Connected components of a graph that is given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b): component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    that chains halve. Rounds end when no label changes. Every round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "links")
    labels = written(
        edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("after"))
        following = written(lower.join(jump, "label").select("node", "before", F.least("label", "after").alias("label")), "labels")
        changed = following.where("label <> before").limit(1).count()
        labels = following.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")

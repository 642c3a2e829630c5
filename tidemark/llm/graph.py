"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def connect(links: DataFrame) -> DataFrame:
    """id and label (the smallest id reachable) of every node of ``links`` (a, b).

    Every round takes the smallest label among the neighbours and then the label of that label,
    which shortens chains by half; rounds end when nothing changes. Each round is a written
    table, so a lost executor costs one round at most.
    """
    both = links.select("a", "b").union(links.select("b", "a")).toDF("id", "other").distinct()
    edges = materialize(both)
    labels = materialize(edges.groupBy("id").agg(F.least("id", F.min("other")).alias("label")))
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("other"), F.col("label").alias("seen")), "other")
            .groupBy("id")
            .agg(F.min("seen").alias("seen"))
        )
        lower = labels.join(near, "id").select("id", F.least("label", "seen").alias("label"), F.col("label").alias("was"))
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("further"))
        step = materialize(
            lower.join(jump, "label").select(
                "id", F.least("label", "further").alias("label"), (F.least("label", "further") != F.col("was")).alias("moved")
            )
        )
        labels = step.select("id", "label")
        if step.where("moved").isEmpty():
            return labels

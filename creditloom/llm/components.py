"""Connected components of an edge table by smallest-label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written as stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that links reach. Each round is written, so lineage stays short."""
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("to")).where("node <> to")
    both = stage(both.unionByName(both.select(F.col("to").alias("node"), F.col("node").alias("to"))).distinct(), "links")
    labels = stage(both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = (
            both.join(labels.select(F.col("node").alias("to"), "label"), "to")
            .groupBy("node").agg(F.min("label").alias("near"))
        )
        step = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = step.join(ahead, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")
        )
        step = stage(step, "labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels

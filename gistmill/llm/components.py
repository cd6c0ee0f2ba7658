"""Connected components of a table of links, by least label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import written


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node that each node of ``links`` (a, b) reaches, itself included.

    A round takes the least label among a node and its neighbours and then the
    label of that label, so rounds grow with the logarithm of a chain's length.
    Each round is a written table; only the count of changes reaches the driver.
    """
    both = written(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "links")
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "component")
        least = written(near.union(labels).groupBy("node").agg(F.min("component").alias("component")), "least")
        up = least.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = written(
            least.join(up, "component", "left")
            .select("node", F.coalesce("above", "component").alias("component")), "labels")
        changed = jumped.join(labels.withColumnRenamed("component", "before"), "node").where("component <> before")
        labels = jumped
        if changed.isEmpty():
            return labels

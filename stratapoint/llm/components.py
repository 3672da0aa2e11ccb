"""Connected components of a table of links, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """From links (a, b): node, component (its smallest node), for all nodes that have a link.

    Each round a node takes the least label among its neighbours and then the label of its label, so that chains
    shrink by half; the table of labels is written to the shared folder after every round. It ends when none changes.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        taken = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "component", F.least("component", "near").alias("now"))
        up = labels.select(F.col("node").alias("now"), F.col("component").alias("up"))
        after = stored(taken.join(up, "now", "left").select("node", "component", F.least("now", F.coalesce("up", "now")).alias("now")), "labels")
        changed = after.where("now <> component").limit(1).count()
        labels = after.select("node", F.col("now").alias("component"))
        if not changed:
            return labels

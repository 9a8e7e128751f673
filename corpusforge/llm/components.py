"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusforge.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (a, b).

    Each round takes the smallest label among the neighbours and then the label of the label, so
    long chains halve. Every round is a written table; only the count of changes reaches the driver.
    """
    links = links.select(F.col("a"), F.col("b"))
    both = cut_lineage(links.union(links.select("b", "a")).distinct(), "links")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(around, labels.node == around.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        low = low.select("node", F.least("label", "old").alias("label"), "old")
        target = low.select(F.col("node").alias("t"), F.col("label").alias("next"))
        jumped = low.join(target, low.label == target.t, "left")
        new = cut_lineage(jumped.select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "old"), "labels")
        if not new.where("label <> old").limit(1).count():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")

"""Connected components by joins: smallest label of the neighbours, then a jump to the label's own label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import Tables


def connected(links: DataFrame) -> DataFrame:
    """node and label (smallest node of the component) of every node of links (a, b).

    Each round halves long chains, so rounds grow with the logarithm of a component's width. Tables are written
    between rounds; only one number a round reaches the driver.
    """
    tables = Tables(links.sparkSession)
    both = tables.write(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = tables.write(labels, "labels")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around, labels.node == around.a).select("node", F.least("label", "near").alias("next"), "label")
        lower = tables.write(lower, "labels")
        target = lower.select(F.col("node").alias("over"), F.col("next").alias("jump"))
        jumped = lower.join(target, lower.next == target.over, "left")
        jumped = jumped.select("node", F.least("next", F.coalesce("jump", "next")).alias("next"), "label")
        jumped = tables.write(jumped, "labels")
        changed = jumped.filter("next <> label").limit(1).count()
        tables.drop(both, jumped)
        labels = jumped.select("node", F.col("next").alias("label"))
        if not changed:
            tables.drop(jumped)
            return labels

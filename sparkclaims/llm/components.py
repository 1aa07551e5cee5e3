"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """node, component for each node of ``links`` (columns a, b of long ids).

    The component is its smallest node. Every round takes the smallest label
    among the neighbours and then the label of that label, so the rounds grow
    with the logarithm of a path's length. Each round is written to the shared
    folder. Labels of neighbours are combined before the shuffle, so a node
    with very many links is no hot group.
    """
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = materialize(
            labels.join(near, "node").select(
                "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
            ),
            "labels",
        )
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = materialize(
            lower.join(jump, "component", "left").select(
                "node", F.least("component", F.coalesce("further", "component")).alias("component"), "before"
            ),
            "labels",
        )
        moved = after.filter(F.col("component") != F.col("before")).limit(1).count()
        labels = after.select("node", "component")
        if not moved:
            return labels

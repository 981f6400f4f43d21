"""Connected components of a graph given by its edges, all of it in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfeed.workspace import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (columns a, b); ``root`` is the least node of its component.

    Every round takes the least label among the neighbours and then the label's own
    label, so long chains halve. Rounds are written to the shared folder, which
    cuts the lineage and survives lost executors. Self-loops and repeated edges are harmless.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = written(both.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("node"), F.least("a", "l").alias("root")), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("up"))
        labels_next = written(
            hooked.join(jump, "via").select("node", "old", F.least("via", "up").alias("root")), "labels"
        )
        done = labels_next.where("root <> old").isEmpty()
        labels = labels_next.select("node", "root")
        if done:
            return labels

"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordhaul.session import stage


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is its smallest node.

    Each round takes the least label among a node and its neighbours and then the label of that
    label, so the number of rounds grows with the logarithm of a component's width. Rounds are
    written, so that none is computed twice. A node with very many neighbours is one row per task
    in the minimum, and its rows in the joins are split where they are too many.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = stage(both, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
    labels = stage(labels, "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("now")
        )
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("next"))
        moved = lower.join(jump, "now").select(
            "node", "was", F.least("now", "next").alias("component")
        )
        moved = stage(moved, "labels")
        labels = moved.drop("was")
        if moved.where("component <> was").isEmpty():
            return labels

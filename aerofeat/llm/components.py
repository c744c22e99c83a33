"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import stage


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (a, b): the
    smallest node reachable. Each round takes the smallest label of a node's
    neighbours and then that of its label (pointer jumping), so the rounds
    grow with the logarithm of the longest path in practice. Labels are
    written to the shared folder each round, which cuts the lineage; a node
    with very many edges is one row of labels, and its edges are combined
    before the shuffle."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = stage(labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("low")), "low")
        up = low.select(F.col("node").alias("low"), F.col("low").alias("up"))
        labels = stage(low.join(up, "low", "left").select(
            "node", F.least("low", "up").alias("component"), "before"), "labels")
        changed = labels.filter("component <> before").limit(1).count()
        labels = labels.select("node", "component")
        if not changed:
            return labels

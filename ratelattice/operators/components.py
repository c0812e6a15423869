"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b): the smallest node that each node reaches.

    Every round a node takes the smallest label among its own and its neighbours', then the label
    of that label, so labels travel in doubling steps.  Labels are written once per round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = keep(both.filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("__heard"))
        nearer = labels.join(heard, "node").select("node", F.col("component").alias("__old"), F.least("component", "__heard").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("__far"))
        moved = keep(nearer.join(jump, "component").select("node", "__old", F.least("component", "__far").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.filter(F.col("component") != F.col("__old")).isEmpty():
            return labels

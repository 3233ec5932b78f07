"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.session import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Every round takes the smallest label among a node and its neighbours and then follows that
    label once more, so a path of length n takes about log n rounds. A node with very many
    edges costs no task more than others: minima combine before their shuffle, and both
    inputs of a join are stored tables, so adaptive execution can split a hot key.
    """
    both = staged(
        edges.select("a", "b").where("a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct(), "graph")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = staged(
            labels.join(around, labels.node == around.a)
            .select("node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "labels")
        if not lower.where("moved").limit(1).count():
            return labels.withColumnRenamed("label", "component")
        jump = lower.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        labels = staged(
            lower.join(jump, lower.label == jump["to"], "left")
            .select("node", F.least("label", "beyond").alias("label")), "labels")

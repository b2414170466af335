"""Connected components of an undirected graph, by joins and minima only; written to the shared folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of ids -> (node, component): the smallest id reachable from each node of an edge.

    Each round a node takes the smallest label among its own and its neighbours', then that label's label, so that paths
    shorten as fast as they grow; it ends when a round changes nothing. A hub's edges are summed before they meet.
    """
    both = staged(edges.selectExpr("a u", "b v").union(edges.selectExpr("b u", "a v")).where("u != v").distinct(), "component-edges")
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("component")), "component-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), F.col("component").alias("c")), "v").groupBy(F.col("u").alias("node")).agg(F.min("c").alias("c"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "c").alias("at"))
        jump = step.join(labels.select(F.col("node").alias("at"), F.col("component").alias("beyond")), "at").select("node", "old", F.least("at", "beyond").alias("component"))
        moved = staged(jump, "component-labels")
        labels = moved.select("node", "component")
        if moved.where("component != old").isEmpty():
            return labels

"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import keep


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``edges`` (a, b) of longs -> v, component (the smallest v reachable), for all v that have an edge.

    Each round takes every vertex to the smallest label among itself and its neighbours, then to that label's own label,
    so that chains shorten by halves. Rounds are written to the shared folder; only a count of changes reaches the driver.
    """
    both = keep(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "cc-edges")
    labels = keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("component")), "cc-labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("v") == F.col("a")).select("v", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        above = labels.select(F.col("v").alias("w"), F.col("component").alias("above"))
        jumped = lower.join(above, F.col("component") == F.col("w"), "left").select("v", "old", F.least("component", F.coalesce("above", "component")).alias("component"))
        jumped = keep(jumped, "cc-labels")
        labels = jumped.select("v", "component")
        if jumped.where("old <> component").isEmpty():
            return labels
    raise RuntimeError(f"components have not settled in {rounds} rounds")

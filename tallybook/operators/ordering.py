"""Places in a total order over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.graph import settled


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` sorted by ``order`` over all tasks, with their place ``__g`` from 0. Ranges are sorted apart; only their sizes are added up."""
    low = (1 << 33) - 1  # an id holds the task's number above its row's
    placed = settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, within = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit(low))
    sizes = placed.groupBy(part.alias("__p")).agg(F.count("*").alias("n"))
    base = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__base"))
    return placed.join(base, part == F.col("__p")).withColumn("__g", F.col("__base") + within).drop("__id", "__p", "__base")

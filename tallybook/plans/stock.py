"""Stock and reconciliation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def negative_stock(movements: DataFrame, item: str = "item", day: str = "day", quantity: str = "quantity") -> DataFrame:
    """``movements`` -> one row per item that was ever below zero: first_negative, balance (that evening), days_negative.

    Movements of one day are summed first, so only evening balances count. The running sum has two levels: what all earlier months of an
    item add up to, and the days of its month, so a task holds an item's months or one month's days.
    """
    daily = movements.groupBy(item, day).agg(F.sum(quantity).alias("net")).withColumn("__month", F.trunc(day, "MM"))
    earlier = Window.partitionBy("__item").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    months = daily.groupBy(F.col(item).alias("__item"), F.col("__month").alias("__m")).agg(F.sum("net").alias("__net"))
    months = months.withColumn("__before", F.coalesce(F.sum("__net").over(earlier), F.lit(0))).drop("__net")
    within = Window.partitionBy(item, "__month").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    both = daily.join(months, F.col(item).eqNullSafe(F.col("__item")) & F.col("__month").eqNullSafe(F.col("__m")))
    balance = both.withColumn("balance", F.col("__before") + F.sum("net").over(within)).where("balance < 0")
    return balance.groupBy(item).agg(F.min(day).alias("first_negative"), F.min_by("balance", day).alias("balance"), F.count("*").alias("days_negative"))


def receipts_vs_orders(ordered: DataFrame, received: DataFrame, key: list[str]) -> DataFrame:
    """status and lines from ordered (key, ordered) and received (key, received) quantities."""
    both = ordered.join(received, key, "full")
    status = (
        F.when(F.col("ordered").isNull(), "received without order")
        .when(F.col("received").isNull(), "not received")
        .when(F.col("received") < F.col("ordered"), "short")
        .when(F.col("received") > F.col("ordered"), "over")
        .otherwise("exact")
    )
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("lines"))


def two_books(left: DataFrame, right: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """status and n of keys by whether two books' quantities are equal, differ, or are in one only."""
    both = left.join(right, key, "full")
    status = F.when(F.col(a).isNull(), f"only {b}").when(F.col(b).isNull(), f"only {a}").when(F.col(a) == F.col(b), "equal").otherwise("different")
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("n"))

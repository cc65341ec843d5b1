"""Constraints as queries: each finds the rows that break a rule; a load goes on only if none does."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) of conditions that must not be false (null passes), in one scan."""
    counted = rows.agg(*[F.count_if(~c).alias(name) for name, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules])
    return counted.select(F.explode(pairs).alias("r")).select("r.*")


def unique(rows: DataFrame, name: str, key: list[str]) -> DataFrame:
    """(rule, violations): keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit(name).alias("rule"), "violations")


def foreign_key(rows: DataFrame, name: str, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """(rule, violations): rows whose key (if it has no null) is not in the parent. Rows are counted by key first, so a key of many rows is looked up once."""
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parent_columns)])
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(columns)])
    counted = rows.where(there).groupBy(*columns).agg(F.count("*").alias("__n"))
    return counted.join(keys, on, "left_anti").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("violations")).select(F.lit(name).alias("rule"), "violations")

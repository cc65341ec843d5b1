"""Looking up what rows refer to: products, rates, headers, people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_code_or_key(rows: DataFrame, items: DataFrame, code: str, key: str, item_id: str, item_code: str, item_key: str) -> DataFrame:
    """``rows`` with the item's id: by code, or by description key where the row has no code; null if unknown.

    A code or key of several items is no answer, so a row never comes back twice.
    """
    one = lambda c, as_: items.groupBy(F.col(c).alias(as_)).agg(F.min(item_id).alias("least"), F.max(item_id).alias("most")).where("least = most")
    by_code = one(item_code, "__code").select("__code", F.col("least").alias("__by_code"))
    by_key = one(item_key, "__key").select("__key", F.col("least").alias("__by_key"))
    out = rows.join(by_code, F.col(code) == F.col("__code"), "left").join(by_key, F.col(code).isNull() & (F.col(key) == F.col("__key")), "left")
    return out.withColumn(item_id, F.coalesce("__by_code", "__by_key")).drop("__code", "__key", "__by_code", "__by_key")


def fx_rates(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """(currency, month, rate_to_rwf) for every month from ``first`` to ``last`` of the one row of ``rows``."""
    months = rows.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
    steps = (F.year("month") - 2015) * 12 + F.month("month") - 1
    usd = months.select(F.lit("USD").alias("currency"), "month", (1000 + 5 * steps).cast("decimal(12,4)").alias("rate_to_rwf"))
    return usd.unionByName(months.select(F.lit("RWF").alias("currency"), "month", F.lit(1).cast("decimal(12,4)").alias("rate_to_rwf")))


def if_known(rows: DataFrame, column: str, *known: DataFrame) -> DataFrame:
    """``rows`` with ``column`` kept where one of the one-column tables ``known`` has its value, else null. A row never comes back twice.

    Rows without a value meet nothing; they are dealt out by their other columns, since as one null key they would be one task's.
    """
    values = known[0].select(F.col(known[0].columns[0]).alias("__known"))
    for more in known[1:]:
        values = values.unionAll(more.select(F.col(more.columns[0])))
    values = values.where("__known IS NOT NULL").distinct().select("__known", F.struct(F.col("__known").alias("v"), F.lit(0).cast("long").alias("h")).alias("__of"))
    others = [F.col(c) for c in rows.columns if c != column and not isinstance(rows.schema[c].dataType, T.MapType | T.VariantType)] or [F.lit(0)]
    met = F.struct(F.col(column).alias("v"), F.when(F.col(column).isNull(), F.pmod(F.xxhash64(*others), F.lit(4096))).otherwise(0).alias("h"))
    return rows.withColumn("__met", met).join(values, F.col("__met") == F.col("__of"), "left").withColumn(column, F.col("__known")).drop("__known", "__of", "__met")


def with_rates(rows: DataFrame, rates: DataFrame, day: str) -> DataFrame:
    """``rows`` with fx_month and rate_to_rwf of their currency in the month of ``day``; the rate is null where there is none."""
    known = rates.select("currency", F.col("month").alias("fx_month"), "rate_to_rwf")
    return rows.withColumn("fx_month", F.trunc(day, "MM")).join(known, ["currency", "fx_month"], "left")


def convert(amount: Column, rate: Column) -> Column:
    """To two places, half up."""
    return F.round(amount * rate, 2).cast("decimal(18,2)")


def header_mismatches(lines: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """``lines`` with ``header_ok``: whether they agree (nulls too) with the first line of their document."""
    w = Window.partitionBy(key).orderBy(*order)
    first = F.first(F.struct(*fields)).over(w)
    return lines.withColumn("header_ok", F.struct(*fields).eqNullSafe(first))


def by_unique_name(rows: DataFrame, people: DataFrame, code: str, key: str) -> DataFrame:
    """``rows`` with resolved_code and reason: the code if there is one, else that of the only person with the name key."""
    names = people.groupBy(F.col(key).alias("__key")).agg(F.min(code).alias("__least"), F.max(code).alias("__most"))
    out = rows.join(names, F.col(code).isNull() & (F.col(key) == F.col("__key")), "left")
    only = F.col("__least") == F.col("__most")
    reason = F.when(F.col(code).isNotNull() | only, None).when(F.col("__least").isNull(), "UNKNOWN_EMPLOYEE").otherwise("AMBIGUOUS_EMPLOYEE")
    return out.withColumns({"resolved_code": F.coalesce(code, F.when(only, F.col("__least"))), "reason": reason}).drop("__key", "__least", "__most")

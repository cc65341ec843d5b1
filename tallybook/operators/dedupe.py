"""First-wins merging of repeated records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallybook.operators.ordering import numbered


def fingerprint(*values: Column) -> Column:
    """One text of the business values; null ones are skipped, decimals must have one scale."""
    return F.concat_ws("|", *[v.cast("string") for v in values])


def first_copies(rows: DataFrame, key: list[str], order: list[str], print_column: str, keep: list[str]) -> DataFrame:
    """``rows`` with kept_print and, for each column of ``keep``, kept_<column> of the first copy, and whether they are it (``is_first``).

    ``order`` must tell all copies of a key apart. The first copy is a minimum, combined before the shuffle, and joined back: rows of a
    frequent key are spread by the join's skew handling and never sorted in one task.
    """
    first = F.min_by(F.struct(F.col(print_column).alias("print"), *[F.col(c).alias(f"kept_{c}") for c in keep], F.struct(*order).alias("at")), F.struct(*order))
    firsts = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(first.alias("__first"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
    found = {"kept_print": F.col("__first.print"), "is_first": F.struct(*order) == F.col("__first.at")} | {f"kept_{c}": F.col(f"__first.kept_{c}") for c in keep}
    return rows.join(firsts, same).withColumns(found).drop("__first", *[f"__{k}" for k in key])


#: A key is hot if it has about so many rows: more than a task should sort.
HOT_ROWS = 500_000


def hot_keys(rows: DataFrame, key: list[str], most: int = HOT_ROWS) -> list[Row]:
    """Keys with some ``most`` rows or more, by the counts of a sample as it is taken for ranges; at most one for each ``most`` rows or so. It only says how rows are dealt."""
    share = min(1.0, 500 / most)
    return rows.select(*key).sample(share, 1).groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") >= most * share).select(*key).collect()


def rank_copies(rows: DataFrame, key: list[str], order: list[str], print_column: str | None, keep: list[str], most: int = HOT_ROWS) -> DataFrame:
    """``rows`` with copy_no, and kept_print (if there is a print) and kept_<column> of the first copy.

    Rows go through one shuffle by their key and a window. Only rows of hot keys are sorted by key and order in ranges, so that they are
    sorted by several tasks; there a copy's number is its place less that of the key's first.
    """
    kept = {f"kept_{c}": c for c in keep} | ({"kept_print": print_column} if print_column else {})
    w = Window.partitionBy(*key).orderBy(*order)
    windowed = lambda df: df.withColumns({"copy_no": F.row_number().over(w)} | {name: F.first(c).over(w) for name, c in kept.items()})
    hot = hot_keys(rows, key, most)
    if not hot:
        return windowed(rows)
    known = rows.sparkSession.createDataFrame(hot, rows.select(*key).schema).toDF(*[f"__{k}" for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
    ranged = first_copies(numbered(rows.join(F.broadcast(known), same, "left_semi"), *key, *order), key, ["__g"], print_column or keep[0], ["__g", *keep])
    ranged = ranged.withColumn("copy_no", (F.col("__g") - F.col("kept___g") + 1).cast("int"))
    cold = windowed(rows.join(F.broadcast(known), same, "left_anti"))
    return cold.unionByName(ranged.select(*cold.columns))


def outcome(print_column: str = "print", first: Column | None = None) -> Column:
    """loaded for the first copy, merged for one with the same values, rejected for one with others."""
    same = F.col(print_column) == F.col("kept_print")
    return F.when(F.col("copy_no") == 1 if first is None else first, "loaded").when(same, "merged").otherwise("rejected")


def row_outcome(kind: Column, reason: Column, reason_category: Column, kept: Column) -> Column:
    """A source row's fate: noise is skipped, a reason rejects, a kept row merges, all else loads."""
    return F.when(reason_category == "noise", "skipped").when(reason.isNotNull(), "rejected").when(kept.isNotNull(), "merged").otherwise("loaded")

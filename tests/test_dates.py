"""Dates of long sheets: conventions and neighbours over several tasks, equal to one pass over each sheet."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybook.functions import dates
from tallybook.operators.ordering import numbered


def one_pass(rows):
    """(sheet, row) -> date, by looking at each sheet whole."""
    out = {}
    shown = lambda some: {m for _, _, _, m, *_ in some} & {"day_first", "month_first"}
    for book in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == book]
        for sheet in {r[1] for r in mine}:
            here = sorted(r for r in mine if r[1] == sheet)
            says = shown(here)
            rule = next(iter(says)) if len(says) == 1 else next(iter(shown(mine))) if not says and len(shown(mine)) == 1 else None
            for i, (_, _, n, method, value, dmy, mdy) in enumerate(here):
                if method != "ambiguous":
                    out[book, sheet, n] = value
                    continue
                above = next((r[4] for r in reversed(here[max(0, i - 15) : i]) if r[4]), None)
                below = next((r[4] for r in here[i + 1 : i + 16] if r[4]), None)
                known = [d for d in (above, below) if d]
                fits = lambda d: bool(known) and min(known) - dt.timedelta(7) <= d <= max(known) + dt.timedelta(7)  # noqa: E731, B023
                near = dmy if fits(dmy) and not fits(mdy) else mdy if fits(mdy) and not fits(dmy) else None
                out[book, sheet, n] = dmy if rule == "day_first" else mdy if rule == "month_first" else near
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_long_sheets_are_split(spark, block):
    rng = random.Random(block)
    rows = []
    for book, sheet, n in (("a", 0, 700), ("a", 1, 3), ("b", 0, 40), ("b", 1, 300), ("c", 0, 1), ("c", 1, 90)):
        for i in range(n):
            d = dt.date(2019, 1, 1) + dt.timedelta(i * 330 // n)
            kinds = {"a": ["iso", "ambiguous", "ambiguous", "invalid", "day_first" if i % 2 else "month_first"], "b": ["ambiguous", "iso"], "c": ["ambiguous", "day_first"]}[book]
            method = rng.choice(kinds) if (book, sheet) != ("b", 1) or i % 40 == 0 else "ambiguous"
            d = d.replace(day=1 + i % 12) if method == "ambiguous" else d
            swapped = dt.date(2019, d.day, d.month) if method == "ambiguous" else None
            dmy, mdy = (d, swapped) if rng.random() < 0.5 else (swapped, d)
            value = None if method in ("ambiguous", "invalid") else d
            rows.append((book, sheet, i, method, value, dmy if method == "ambiguous" else None, mdy if method == "ambiguous" else None))
    given = spark.createDataFrame(rows, "book string, sheet int, row_num int, method string, value date, day_first date, month_first date").withColumns(
        {"t": F.struct("value", "method", "day_first", "month_first"), "range_start": F.lit("2018-01-01").cast("date"), "range_end": F.lit("2020-12-31").cast("date")}
    )
    got = dates.resolve_dates(given.select("book", "sheet", "row_num", "t", "range_start", "range_end"), "t", block=block)
    assert {(r["book"], r["sheet"], r["row_num"]): r["date"] for r in got.collect()} == one_pass(rows)
    assert got.columns == ["book", "sheet", "row_num", "t", "range_start", "range_end", "date", "date_method", "date_reason"]


def test_one_sheet_goes_to_several_tasks(spark):
    rows = spark.range(30_000).select(F.lit("b").alias("book"), F.lit(0).alias("sheet"), F.col("id").alias("row_num"))
    placed = dates.along(numbered(rows, "book", "sheet", "row_num"), 4096, 15)
    sizes = [r["n"] for r in placed.groupBy("__block").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 4096 + 30 and len(sizes) >= 8 and placed.where("__own").count() == 30_000
    assert numbered(rows, "book", "sheet", "row_num").where("__g <> row_num").count() == 0

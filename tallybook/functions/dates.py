"""Dates typed by hand, read in two passes.

The first pass reads a cell alone: a struct (value, method, day_first, month_first). A cell such as 04/05/2019 is ``ambiguous``
and keeps both readings. The second settles those from their sheet, else their book, else their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.text import let, trimmed
from tallybook.operators.ordering import numbered

SERIAL = (32874, 73050)  # 1990-01-01 to 2099-12-31 in days since 1899-12-30
REACH, SLACK, MARGIN = 15, 7, 62  # rows to look up and down; days around neighbours; days around a book's year
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_ISO = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$"
_SLASHED = r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4}|\d{2})$"


def day(year: Column, month: Column, date: Column) -> Column:
    """That date, or null if the calendar has none (also for year 0)."""
    zero = F.lit(0)
    return F.when(year > 0, F.try_make_timestamp(year, month, date, zero, zero, zero).cast("date"))


def full_year(text: Column, pivot: int) -> Column:
    """Two digits below the pivot are in the 2000s; four digits stay."""
    n = text.try_cast("int")
    return F.when(F.length(text) == 4, n).when(n < pivot, 2000 + n).otherwise(1900 + n)


def month_number(name: Column) -> Column:
    """1 to 12 for a prefix of at least three letters of an English month."""
    key = F.lower(name)
    out = F.lit(None).cast("int")
    for i in range(12, 0, -1):
        out = F.when((F.length(key) >= 3) & F.lit(_MONTHS[i - 1]).startswith(key), i).otherwise(out)
    return out


def _exact_month(name: Column) -> Column:
    """1 to 12 for a month's full name or its first three letters."""
    key = F.lower(name)
    out = F.lit(None).cast("int")
    for i, m in enumerate(_MONTHS, 1):
        out = F.when(key.isin(m, m[:3]), i).otherwise(out)
    return out


def _token(value: Column | None, method: Column | str, day_first: Column | None = None, month_first: Column | None = None) -> Column:
    none = F.lit(None).cast("date")
    method = F.lit(method) if isinstance(method, str) else method
    return F.struct(
        (none if value is None else value).alias("value"), method.alias("method"),
        (none if day_first is None else day_first).alias("day_first"), (none if month_first is None else month_first).alias("month_first"),
    )


def serial(n: Column) -> Column:
    """A spreadsheet's day number as a token."""
    ok = n.between(*SERIAL)
    value = F.when(ok, F.date_add(F.lit("1899-12-30").cast("date"), F.when(ok, F.floor(n)).cast("int")))
    return _token(value, F.when(ok, "excel_serial").otherwise("invalid"))


_TEXTS = (  # shapes with the groups of day, month and year
    (r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$", (1, 2, 3)),
    (r"^(\d{1,2})-([A-Za-z]{3})-(\d{2})$", (1, 2, 3)),
    (r"^(\d{1,2})-([A-Za-z]+)-(\d{4})$", (1, 2, 3)),
    (r"^([A-Za-z]+)\s+(\d{1,2}),\s*(\d{4})$", (2, 1, 3)),
    (r"^(\d{1,2})\s+([A-Za-z]{3})\s+(\d{2})$", (1, 2, 3)),
)


def tokenize(c: Column) -> Column:
    """The token of a text cell."""
    read = lambda value, method: _token(value, F.when(value.isNotNull(), method).otherwise("invalid"))

    def iso(s: Column) -> Column:
        n = [F.regexp_extract(s, _ISO, i).try_cast("int") for i in (1, 2, 3)]
        return let(day(*n), lambda d: read(d, "iso"))

    def slashed(s: Column) -> Column:
        part = lambda i: F.regexp_extract(s, _SLASHED, i)
        numbers = F.array(part(1).try_cast("int"), part(2).try_cast("int"), full_year(part(3), 70))
        return let(numbers, lambda n: let(F.array(day(n[2], n[1], n[0]), day(n[2], n[0], n[1])), lambda d: chosen(n[0], n[1], d[0], d[1])))

    def chosen(a: Column, b: Column, dmy: Column, mdy: Column) -> Column:
        return (
            F.when(a == b, read(mdy, "same_day_month"))
            .when((a > 12) & (b <= 12), read(dmy, "day_first"))
            .when((b > 12) & (a <= 12), read(mdy, "month_first"))
            .when(dmy.isNotNull() & mdy.isNotNull(), _token(None, "ambiguous", dmy, mdy))
            .otherwise(_token(None, "invalid"))
        )

    def written(s: Column) -> Column:
        found = []
        for shape, (d, m, y) in _TEXTS:
            group = lambda i, shape=shape: F.regexp_extract(s, shape, i)
            value = let(F.struct(full_year(group(y), 69).alias("y"), _exact_month(group(m)).alias("m"), group(d).try_cast("int").alias("d")), lambda p: day(p["y"], p["m"], p["d"]))
            found.append(F.when(s.rlike(shape), value))
        return let(F.coalesce(*found), lambda d: read(d, "text_month"))

    def token(s: Column) -> Column:
        return (
            F.when(s == "", _token(None, "missing"))
            .when(s.rlike(r"^\d+$"), let(s.try_cast("double"), serial))
            .when(s.rlike(_ISO), iso(s))
            .when(s.rlike(_SLASHED), slashed(s))
            .otherwise(written(s))
        )

    return let(trimmed(F.coalesce(c, F.lit(""))), token)


def valid_range(year: Column) -> tuple[Column, Column]:
    """A book's period: its year and two months around it; 2000 to 2030 without a year."""
    first, last = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    return F.coalesce(F.date_sub(first, MARGIN), F.lit("2000-01-01").cast("date")), F.coalesce(F.date_add(last, MARGIN), F.lit("2030-12-31").cast("date"))


def _convention(days: Column, months: Column) -> Column:
    return F.when(days & months, "MIXED").when(days, "DMY").when(months, "MDY").otherwise("NONE")


def conventions(rows: DataFrame, method: Column, book: str, sheet: str) -> DataFrame:
    """(book, sheet, __sheet, __book): which order of day and month the clear dates of each sheet and book show. A row a sheet, counted map-side."""
    seen = [F.bool_or(F.coalesce(method == m, F.lit(False))).alias(m) for m in ("day_first", "month_first")]
    sheets = rows.groupBy(book, sheet).agg(*seen)
    books = sheets.groupBy(F.col(book).alias("__b")).agg(F.bool_or("day_first").alias("days"), F.bool_or("month_first").alias("months"))
    both = sheets.join(books, F.col(book).eqNullSafe(F.col("__b")))
    return both.select(F.col(book).alias("__b"), F.col(sheet).alias("__s"), _convention(F.col("day_first"), F.col("month_first")).alias("__sheet"), _convention(F.col("days"), F.col("months")).alias("__book"))


def along(rows: DataFrame, block: int, reach: int) -> DataFrame:
    """``rows`` (with ``__g``) dealt into blocks of ``block`` places, those within ``reach`` of an edge also into the next block: ``__block`` and ``__own``."""
    own, at = F.floor(F.col("__g") / block), F.pmod("__g", F.lit(block))
    into = F.array(own, F.when(at < reach, own - 1), F.when(at >= block - reach, own + 1))
    return rows.withColumn("__own_block", own).withColumn("__block", F.explode(F.array_compact(into))).withColumn("__own", F.col("__block") == F.col("__own_block")).drop("__own_block")


def resolve_dates(rows: DataFrame, token: str, book: str = "book", sheet: str = "sheet", order: str = "row_num", start: str = "range_start", end: str = "range_end", block: int = 4096) -> DataFrame:
    """``rows`` with date, date_method and date_reason from its ``token`` column.

    Ambiguous readings: the sheet's convention if its clear dates agree; the book's if the sheet has no evidence at all;
    else the one reading that lies within a week of the nearest clear dates up to 15 rows above and below.

    Neither a sheet nor a book is one task's: conventions are joined back, and neighbours are looked up in blocks of ``block`` rows.
    """
    t = F.col(token)
    inside = lambda c: c.between(F.col(start), F.col(end))
    clear = F.when(inside(t["value"]), t["value"])
    placed = along(numbered(rows, book, sheet, order), block, REACH)
    near_rows = Window.partitionBy("__block", book, sheet).orderBy("__g")
    placed = placed.withColumns(
        {"__above": F.last(clear, ignorenulls=True).over(near_rows.rowsBetween(-REACH, -1)), "__below": F.first(clear, ignorenulls=True).over(near_rows.rowsBetween(1, REACH))}
    ).where("__own")
    shown = conventions(rows, t["method"], book, sheet)
    rows = placed.join(shown, F.col(book).eqNullSafe(F.col("__b")) & F.col(sheet).eqNullSafe(F.col("__s")))
    sheet_says, book_says = F.col("__sheet"), F.col("__book")
    decided = F.when(sheet_says.isin("DMY", "MDY"), sheet_says).when((sheet_says == "NONE") & book_says.isin("DMY", "MDY"), book_says)
    by = F.when(sheet_says.isin("DMY", "MDY"), "sheet_convention").otherwise("book_convention")
    low = F.date_sub(F.least("__above", "__below"), SLACK)
    high = F.date_add(F.greatest("__above", "__below"), SLACK)
    fits = lambda c: F.coalesce(c.between(low, high), F.lit(False))
    near = F.when(fits(t["day_first"]) & ~fits(t["month_first"]), t["day_first"]).when(fits(t["month_first"]) & ~fits(t["day_first"]), t["month_first"])
    result = lambda value, method, reason: F.struct(value.cast("date").alias("v"), method.alias("m"), reason.cast("string").alias("r"))
    none, no_reason = F.lit(None).cast("date"), F.lit(None).cast("string")
    found = (
        F.when(t["method"] == "missing", result(none, t["method"], F.lit("MISSING_FIELD")))
        .when(t["method"] == "invalid", result(none, t["method"], F.lit("BAD_DATE")))
        .when(t["value"].isNotNull(), F.when(inside(t["value"]), result(t["value"], t["method"], no_reason)).otherwise(result(none, t["method"], F.lit("DATE_OUT_OF_RANGE"))))
        .when(~inside(t["day_first"]) & ~inside(t["month_first"]), result(none, F.lit("ambiguous"), F.lit("DATE_OUT_OF_RANGE")))
        .when(decided == "DMY", result(t["day_first"], by, no_reason))
        .when(decided == "MDY", result(t["month_first"], by, no_reason))
        .when(near.isNotNull(), result(near, F.lit("neighbours"), no_reason))
        .otherwise(result(none, F.lit("ambiguous"), F.lit("AMBIGUOUS_DATE")))
    )
    rows = rows.withColumn("__d", found)
    return rows.withColumns({"date": F.col("__d.v"), "date_method": F.col("__d.m"), "date_reason": F.col("__d.r")}).drop("__sheet", "__book", "__above", "__below", "__d", "__g", "__block", "__own", "__b", "__s")


def parse_period(name: Column, default_year: Column) -> Column:
    """The first of the month that a payroll sheet's name means, else null."""
    s = F.regexp_replace(trimmed(name), r"\s*\(\d+\)\s*$", "")
    ym, my, named = r"^(\d{4})[-./](\d{1,2})$", r"^(\d{1,2})[-./](\d{4})$", r"^([A-Za-z]+)[\s\-]*(\d{2}|\d{4})?$"
    n = lambda shape, i: F.regexp_extract(s, shape, i).try_cast("int")
    typed = F.regexp_extract(s, named, 2)
    year = F.when(typed != "", full_year(typed, 70)).otherwise(default_year)
    one = F.lit(1)
    return F.when(s.rlike(ym), day(n(ym, 1), n(ym, 2), one)).when(s.rlike(my), day(n(my, 2), n(my, 1), one)).when(s.rlike(named), day(year, month_number(F.regexp_extract(s, named, 1)), one))

"""Finding the table in a sheet and saying what each of its rows is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import text
from tallybook.vocabulary import CURRENCIES, HEADER_HINT, KEY_FIELD, REQUIRED, SUBTOTAL, SYNONYMS

SEARCH_ROWS = 12
_SHEET = ["book", "sheet_index"]


def domain_of(book: Column) -> Column:
    """The domain that a file name stands for, or null."""
    name = F.lower(book)
    out = F.when(name.startswith("item_master"), "products")
    for domain in ("purchases", "sales", "inventory", "payroll"):
        out = out.when(name.startswith(domain + "_"), domain)
    return out


def year_of(book: Column) -> Column:
    return F.nullif(F.regexp_extract(book, r"_(\d{4})(?:[_.]|$)", 1), F.lit("")).cast("int")


def label_of(cell: Column) -> tuple[Column, Column]:
    """(label, currency hint) of a header cell: ``Amount (Frw)`` -> amount, RWF."""
    raw = F.lower(text.clean(cell))
    hints = F.transform(F.regexp_extract_all(raw, F.lit(HEADER_HINT), F.lit(1)), lambda x: text.lookup(x, CURRENCIES))
    hint = F.get(F.filter(hints, lambda x: x.isNotNull()), F.lit(0))
    label = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, HEADER_HINT, " "), "[.:]", " "), r"(?U)\s+", " "))
    return label, hint


def find_layouts(grids: DataFrame) -> DataFrame:
    """book, sheet_index, sheet, domain, year, header_row, fields (entries column, field, label), hints, skipped_reason per sheet.

    The header is the row, of the first twelve, with a field of every required group and most fields; the earliest of equals.
    A label is tried with the label above it first; a field belongs to its first column.
    """
    spark = grids.sparkSession
    words = spark.createDataFrame([(d, s, f) for d, fields in SYNONYMS.items() for f, labels in fields.items() for s in labels], "domain string, label string, field string")
    needs = spark.createDataFrame(list(REQUIRED.items()), "domain string, groups array<array<string>>")
    sheets = grids.where("row_num = 0").select(*_SHEET, "sheet", domain_of(F.col("book")).alias("domain"), year_of(F.col("book")).alias("year"))
    top = grids.where(F.col("row_num").between(1, SEARCH_ROWS)).select(*_SHEET, "row_num", domain_of(F.col("book")).alias("domain"), F.posexplode("cells").alias("i", "c"))
    label, hint = label_of(F.col("c.s"))
    top = top.select(*_SHEET, "row_num", "domain", "i", label.alias("label"), hint.alias("hint"))
    above = Window.partitionBy(*_SHEET, "i").orderBy("row_num")
    top = top.withColumns({"p_label": F.lag("label").over(above), "p_hint": F.lag("hint").over(above)}).where("label <> ''")
    top = top.withColumn("long", F.when((F.col("p_label") != "") & (F.col("p_label") != F.col("label")), F.concat_ws(" ", "p_label", "label")))
    w1 = words.select("domain", F.col("label").alias("long"), F.col("field").alias("f1"))
    w2 = words.select("domain", "label", F.col("field").alias("f2"))
    found = top.join(w1, ["domain", "long"], "left").join(w2, ["domain", "label"], "left").withColumn("field", F.coalesce("f1", "f2")).where("field IS NOT NULL")
    first = Window.partitionBy(*_SHEET, "row_num", "field").orderBy("i")
    found = found.withColumn("n", F.row_number().over(first)).where("n = 1")
    entry = F.struct("i", "field", "label", F.coalesce("hint", "p_hint").alias("hint"))
    rows = found.groupBy(*_SHEET, "domain", "row_num").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    names = F.transform("entries", lambda e: e["field"])
    rows = rows.join(needs, "domain").where(F.forall("groups", lambda g: F.arrays_overlap(g, names)))
    best = rows.groupBy(*_SHEET).agg(F.max_by(F.struct("row_num", "entries"), F.struct(F.size("entries"), -F.col("row_num"))).alias("best"))
    hints = F.map_from_entries(F.transform(F.filter("best.entries", lambda e: e["hint"].isNotNull()), lambda e: F.struct(e["field"], e["hint"])))
    out = sheets.join(best, _SHEET, "left")
    skipped = F.when(F.col("domain").isNull(), "file name does not identify a domain").when(F.col("best").isNull(), "no recognisable header")
    return out.select(*_SHEET, "sheet", "domain", "year", F.col("best.row_num").alias("header_row"), F.col("best.entries").alias("entries"), hints.alias("hints"), skipped.alias("skipped_reason"))


def _readable_key(domain: Column, cells: Column) -> Column:
    key = lambda d: cells[KEY_FIELD[d]]["s"]
    return (
        F.when(domain == "payroll", text.employee(key("payroll")).isNotNull())
        .when(domain == "products", text.sku(key("products")).isNotNull())
        .when(domain == "purchases", text.document(key("purchases"), "purchases").isNotNull())
        .when(domain == "sales", text.document(key("sales"), "sales").isNotNull())
        .otherwise(text.document(key("inventory"), "inventory").isNotNull())
    )


def classify_rows(grids: DataFrame, layouts: DataFrame, *more: str) -> DataFrame:
    """Rows below the headers: book, sheet_index, sheet, row_num, domain, year, kind (data, blank, subtotal, repeated_header), cells (map by field), hints, fields, and the columns ``more`` of ``grids``."""
    rows = grids.where("row_num > 0").drop("sheet").join(layouts.where("skipped_reason IS NULL"), _SHEET).where("row_num > header_row")
    pairs = F.transform("entries", lambda e: F.struct(e["field"].alias("key"), F.get(F.col("cells"), e["i"]).alias("value")))
    rows = rows.withColumn("cells", F.map_from_entries(pairs))
    texts = F.transform("entries", lambda e: text.clean(F.try_element_at(F.col("cells"), e["field"])["s"]))
    rows = rows.withColumn("__texts", texts)
    same = F.size(F.filter(F.arrays_zip(F.col("__texts").alias("t"), F.col("entries").alias("e")), lambda x: F.lower(x["t"]) == x["e"]["label"]))
    kind = (
        F.when(~F.exists("__texts", lambda t: t != ""), "blank")
        .when(same >= F.greatest(F.lit(2), F.floor(F.size("entries") * 0.6)), "repeated_header")
        .when(F.exists("__texts", lambda t: t.rlike(SUBTOTAL)) & ~F.coalesce(_readable_key(F.col("domain"), F.col("cells")), F.lit(False)), "subtotal")
        .otherwise("data")
    )
    return rows.select(*_SHEET, "sheet", "row_num", "domain", "year", kind.alias("kind"), "cells", "hints", F.transform("entries", lambda e: e["field"]).alias("fields"), *more)

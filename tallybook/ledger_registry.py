"""Queries that write the given tables as workbook rows and read them again: layouts, row kinds, row parsers, dates, supplier names, constraints."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.functions import dates, text
from tallybook.operators import dedupe, matching, resolve, upsert
from tallybook.operators.graph import scratch, settled
from tallybook.operators.ordering import numbered
from tallybook.plans import load, reports, scoring
from tallybook.plans import rows as parse
from tallybook.registry import ORACLE_SQL, query, read, spread
from tallybook.sources.layout import SEARCH_ROWS, classify_rows, find_layouts

def _null() -> Column:
    return F.lit(None).cast("string")


def cell(s: Column | str, kind: str = "t") -> Column:
    s = F.lit(s) if isinstance(s, str) else s
    return F.when(s.isNotNull(), F.struct(F.lit(kind).alias("kind"), s.cast("string").alias("s")))


def pick(number: Column, *values: Column | str | None) -> Column:
    """The value at ``number`` modulo their count."""
    given = [_null() if v is None else F.lit(v) if isinstance(v, str) else v for v in values]
    return F.get(F.array(*given), F.pmod(number, F.lit(len(given))).cast("int"))


def fields(**values: Column) -> Column:
    """Named texts as the cells of a row."""
    return F.map_from_arrays(F.array(*[F.lit(f) for f in values]), F.array(*[cell(v) for v in values.values()]))


# --- sheets ---------------------------------------------------------------------------------------

_BOOKS = ("'purchases_2019.xlsx'", "'Sales_2020_b.xlsx'", "'payroll_1998.xlsx'", "'item_master.xlsx'", "'inventory_2021.xlsx'", "'notes_2019.xlsx'", "'purchases_2018.xlsx'")


def _grids(spark: SparkSession, sf_dir: str, lines_each: int | None = None) -> DataFrame:
    """One sheet per supplier: up to three rows of title, a header of its domain in one or two rows, and lines of that supplier below (the first ``lines_each``)."""
    k = F.col("l_suppkey")
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", F.col("l_returnflag").alias("f"))
    book = pick(k, "purchases_2019.xlsx", "Sales_2020_b.xlsx", "payroll_1998.xlsx", "item_master.xlsx", "inventory_2021.xlsx", "notes_2019.xlsx", "purchases_2018.xlsx")
    sheets = lines.select("l_suppkey").distinct().select(k, book.alias("book"), k.cast("int").alias("sheet_index"), F.concat(F.lit("S"), k.cast("string")).alias("sheet"))
    row = lambda *cells: F.array(*[cell(c) if c is not None else cell(_null()) for c in cells])
    blank, title = row(None, None, None, None, None, None), row("Ledger", None, None, None, None, None)
    heads = [
        [row("DATE", "PO  No.", "Supplier Name", "Item Code", "Qty", "Amount (Frw)")],
        [row("Date", "Receipt No", "Channel", "Item Code", "Qty", "Total (US$)")],
        [row("Emp No", "Names", "Position", "Gross Pay", "Deductions", "Net Pay")],
        [row("Code", "Description", "Category", "Unit", None, None)],
        [row("Date", "Document", "Code", "Movement", "Quantity", "Quantity"), row("Date", "Number", "Code", "Type", "In", "Out")],
        [row("Date", "PO No", "Supplier", "Item Code", "Qty", "Amount")],
        [row("Date", "Supplier", "Item Code", "Qty", "Amount", None)],
    ]
    pad = [F.array_repeat(title, F.pmod(k, F.lit(4)).cast("int")), F.array()]
    top = F.coalesce(*[F.when(F.pmod(k, F.lit(7)) == i, F.concat(pad[0], F.array(*h))) for i, h in enumerate(heads)])
    n = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(9))
    po, amount = F.concat(pick(k, "PO-2019-", "RCT-2019-", "PO-2019-", "PO-2019-", "GRN-2019-", "PO-2019-", "PO-2019-"), (F.col("l_orderkey") % 100000).cast("string")), F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    body = (
        F.when(n == 0, blank).when(n == 1, row("Sub-Total", None, None, None, None, amount)).when(n == 2, row("Balance b/f", po, None, None, None, amount))
        .when((n == 3) & (F.pmod(k, F.lit(7)) == 0), row("date", "po no", "Supplier name", "item code", "Remarks", "amount")).otherwise(row(day, po, "Total Barrels", "FAB-COT-001", "5", amount))
    )
    order = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_quantity", "f")
    heading = sheets.select("*", F.posexplode(top).alias("p", "cells")).select("book", "sheet_index", "sheet", (F.col("p") + 1).alias("row_num"), "cells", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("order_key"))
    height = sheets.select("l_suppkey", "book", "sheet", F.size(top).alias("h"))
    placed = lines.withColumn("r", F.row_number().over(order))
    if lines_each is not None:
        placed = placed.where(F.col("r") <= lines_each)
    below = placed.withColumn("cells", body).join(height, "l_suppkey")
    below = below.select("book", k.cast("int").alias("sheet_index"), "sheet", (F.col("r") + F.col("h")).alias("row_num"), "cells", n.cast("long").alias("n"), F.col("l_orderkey").alias("order_key"))
    start = sheets.select("book", "sheet_index", "sheet", F.lit(0).alias("row_num"), F.array().cast("array<struct<kind:string,s:string>>").alias("cells"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("order_key"))
    return start.unionByName(heading).unionByName(below)


_SHEETS = f"""s AS (SELECT DISTINCT l_suppkey AS k, (l_suppkey % 7)::INT AS m, (l_suppkey % 4)::INT AS t FROM lineitem),
b AS (SELECT *, [{", ".join(_BOOKS)}][m + 1] AS book FROM s)"""


@query(f"""WITH {_SHEETS} SELECT book, k::INT AS sheet_index, ['purchases', 'sales', 'payroll', 'products', 'inventory', NULL, 'purchases'][m + 1] AS domain, [2019, 2020, 1998, NULL, 2021, 2019, 2018][m + 1]::INT AS year,
 CASE WHEN m < 5 THEN t + 1 + (m = 4)::INT END::INT AS header_row,
 CASE WHEN m < 5 THEN ['date,po_number,supplier,sku,quantity,amount', 'date,receipt_no,channel,sku,quantity,amount', 'employee_code,name,position,gross,deductions,net', 'sku,description,category,uom', 'date,voucher_no,sku,movement_type,qty_in,qty_out'][m + 1] END AS fields,
 CASE m WHEN 0 THEN 'RWF' WHEN 1 THEN 'USD' END AS amount_hint, CASE m WHEN 5 THEN 'file name does not identify a domain' WHEN 6 THEN 'no recognisable header' END AS skipped_reason FROM b""")
def sheet_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain and year from the file's name, the header row in one or two levels, fields, hints, and why sheets are skipped."""
    out = find_layouts(_grids(spark, sf_dir, SEARCH_ROWS).drop("n", "order_key"))  # no header is looked for below these rows
    names = F.array_join(F.transform("entries", lambda e: e["field"]), ",")
    return out.select("book", "sheet_index", "domain", "year", "header_row", names.alias("fields"), F.try_element_at("hints", F.lit("amount")).alias("amount_hint"), "skipped_reason")


@query(f"""WITH {_SHEETS}, l AS (SELECT b.book, b.k, b.m, (l_orderkey + l_linenumber) % 9 AS n, l_orderkey FROM lineitem JOIN b ON b.k = l_suppkey WHERE m < 5)
 SELECT k::INT AS sheet_index, l_orderkey AS order_key, ['purchases', 'sales', 'payroll', 'products', 'inventory'][m + 1] AS domain,
  CASE WHEN n = 0 THEN 'blank' WHEN n = 1 OR m IN (2, 3) THEN 'subtotal' WHEN n = 3 AND m = 0 THEN 'repeated_header' ELSE 'data' END AS kind,
  CASE WHEN m = 0 AND n > 3 THEN 'Total Barrels' WHEN m = 0 AND n = 3 THEN 'Supplier name' END AS supplier,
  CASE WHEN m IN (0, 1, 4) THEN CASE WHEN n = 3 AND m = 0 THEN 'po no' WHEN n > 1 THEN ['PO', 'RCT', '', '', 'GRN'][m + 1] || '-2019-' || (l_orderkey % 100000)::VARCHAR END END AS document FROM l""")
def row_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all five domains blank rows, subtotals (not where the key can be read, though a name begins like one), pasted headers, and data."""
    layouts = find_layouts(_grids(spark, sf_dir, SEARCH_ROWS).drop("n", "order_key"))  # no header is looked for below these rows
    rows = classify_rows(_grids(spark, sf_dir).where("n IS NOT NULL"), layouts, "order_key")
    get = lambda f: F.try_element_at(F.col("cells"), F.lit(f))["s"]
    document = F.coalesce(get("po_number"), get("receipt_no"), get("voucher_no"))
    return rows.select("sheet_index", "order_key", "domain", "kind", get("supplier").alias("supplier"), document.alias("document"))


# --- row parsers ----------------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their whole numbers: quantity, and the price in cents."""
    return spread(read(spark, sf_dir, "lineitem"), "l_orderkey").withColumns({"q": F.col("l_quantity").cast("long"), "a": F.col("l_extendedprice").cast("decimal(14,2)"), "y": F.year("l_shipdate").cast("string")})


def _given(rows: DataFrame, cells: Column, hints: Column | None = None, names: tuple[str, ...] = (), **more: Column) -> DataFrame:
    return rows.withColumns({
        "cells": cells, "hints": F.create_map().cast("map<string,string>") if hints is None else hints, "fields": F.array(*[F.lit(x) for x in names]),
        "date": F.to_date("l_shipdate") if "l_shipdate" in rows.columns else F.lit(None).cast("date"), "date_method": F.lit("iso"), "date_reason": _null(), **more,
    })


_PRICE = "CASE WHEN q = 0 THEN NULL ELSE (c * 100 // q + CASE WHEN 2 * (c * 100 % q) > q OR (2 * (c * 100 % q) = q AND (c * 100 // q) % 2 = 1) THEN 1 ELSE 0 END) END::DECIMAL(18,0)"


@query(f"""WITH l AS (SELECT *, l_quantity::BIGINT AS q, (l_extendedprice::DECIMAL(14,2) * 100)::BIGINT AS c FROM lineitem),
 v AS (SELECT *, ['showroom', 'showroom', 'wholesale', 'export', NULL, NULL, 'showroom'][(l_linenumber % 7 + 1)::INT] AS ch, CASE WHEN l_orderkey % 2 = 0 THEN 'RWF' END AS marker, CASE WHEN l_linestatus = 'F' AND l_partkey % 3 = 0 THEN 'USD' END AS col,
   CASE WHEN l_orderkey % 3 <> 0 THEN 'RWF' END AS hint, {_PRICE} AS price4 FROM l),
 r AS (SELECT *, CASE WHEN l_orderkey % 13 = 0 THEN 'MISSING_FIELD' WHEN l_orderkey % 11 = 0 THEN 'BAD_CODE' WHEN l_linenumber % 7 = 5 THEN 'MISSING_FIELD' WHEN ch IS NULL THEN 'UNKNOWN_CHANNEL'
   WHEN l_partkey % 17 = 0 THEN 'BAD_CODE' WHEN l_suppkey % 23 = 0 THEN 'AMBIGUOUS_DATE' WHEN q % 10 = 0 THEN 'BAD_QUANTITY' WHEN q % 10 = 7 THEN 'BAD_QUANTITY' WHEN l_suppkey % 10 = 3 THEN 'BAD_AMOUNT'
   WHEN marker <> col THEN 'CURRENCY_CONFLICT' WHEN coalesce(col, marker, hint) IS NULL THEN 'UNKNOWN_CURRENCY' WHEN l_partkey % 4 = 1 THEN 'AMOUNT_MISMATCH' END AS reason FROM v)
 SELECT l_orderkey, l_linenumber, l_partkey, reason, ch AS channel, CASE WHEN l_partkey % 5 <> 0 AND l_partkey % 17 <> 0 THEN 'FAB-COT-' || lpad((l_partkey % 1000)::VARCHAR, 3, '0') END AS sku,
  CASE WHEN l_partkey % 5 = 0 AND l_partkey % 17 <> 0 THEN 'item ' || l_partkey::VARCHAR END AS description_key, CASE WHEN reason IS NULL THEN coalesce(col, marker, hint) END AS currency,
  CASE WHEN reason IS NULL THEN CASE WHEN col IS NOT NULL THEN 'column' WHEN marker IS NOT NULL THEN 'embedded' ELSE 'header' END END AS currency_source, CASE WHEN reason IS NULL THEN (price4 / 10000)::DECIMAL(18,4) END AS unit_price FROM r""")
def parse_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines through the row parser; the first failed check is the reason, and a missing price follows from the amount, half to even."""
    lines = _lines(spark, sf_dir)
    o, p, q = F.col("l_orderkey"), F.col("l_partkey"), F.col("q")
    receipt = F.when(o % 13 == 0, " ").when(o % 11 == 0, "RCX 1").otherwise(F.concat(F.lit("rct "), F.col("y"), F.lit("/"), (o % 100000).cast("string")))
    amount = F.when(F.col("l_suppkey") % 10 == 3, "TBC").when(o % 2 == 0, F.concat(F.lit("Frw "), F.format_number("a", 2), F.lit("/="))).otherwise(F.col("a").cast("string"))
    exact = (F.col("a").cast("decimal(16,4)") / q.cast("decimal(14,6)")).cast("decimal(20,8)")
    cells = fields(
        receipt_no=receipt, channel=pick(F.col("l_linenumber"), " Shop", "retail", "W/Sale", "Export  order", "moon", "", "showroom"),
        sku=F.when(p % 17 == 0, "FABX").when(p % 5 == 0, "").otherwise(F.concat(F.lit("fab cot "), (p % 1000).cast("string"))), description=F.concat(F.lit("Item ("), p.cast("string"), F.lit(")")),
        quantity=F.when(q % 10 == 0, "ten").when(q % 10 == 7, F.concat(F.lit("("), q.cast("string"), F.lit(")"))).otherwise(F.concat(q.cast("string"), F.lit(" pcs"))), amount=amount,
        unit_price=F.when(p % 4 == 1, (exact * 2).cast("string")), currency=F.when((F.col("l_linestatus") == "F") & (p % 3 == 0), "us$").otherwise(""),
    )
    hints = F.when(o % 3 != 0, F.create_map(F.lit("amount"), F.lit("RWF"))).otherwise(F.create_map().cast("map<string,string>"))
    given = _given(lines, cells, hints, date_reason=F.when(F.col("l_suppkey") % 23 == 0, "AMBIGUOUS_DATE"), book=o, sheet_index=F.col("l_linenumber"), row_num=p)
    out = parse.sales(given)
    fine = F.col("reason").isNull()
    return out.select(F.col("book").alias("l_orderkey"), F.col("sheet_index").alias("l_linenumber"), F.col("row_num").alias("l_partkey"), "reason", "channel", "sku", "description_key", F.when(fine, F.col("currency")).alias("currency"), F.when(fine, F.col("currency_source")).alias("currency_source"), F.when(fine, F.col("unit_price")).alias("unit_price"))


@query("""WITH l AS (SELECT *, l_quantity::BIGINT AS q, l_orderkey % 2 = 0 AS pair, ['receipt', 'issue', 'production', 'sale', 'adjustment', NULL, 'receipt'][(l_linenumber % 7 + 1)::INT] AS kind FROM lineitem),
 r AS (SELECT *, CASE WHEN pair THEN CASE WHEN l_returnflag = 'R' THEN q ELSE -q END ELSE CASE WHEN l_suppkey % 2 = 0 THEN -q ELSE q END END AS typed,
  CASE WHEN l_orderkey % 17 = 0 THEN 'BAD_CODE' WHEN l_partkey % 29 = 0 THEN 'BAD_CODE' WHEN kind IS NULL THEN 'UNKNOWN_MOVEMENT_TYPE' WHEN l_suppkey % 31 = 0 THEN 'BAD_DATE' WHEN pair AND l_partkey % 19 = 0 THEN 'BAD_QUANTITY' WHEN NOT pair AND l_partkey % 19 = 0 THEN 'MISSING_FIELD' END AS reason FROM l)
 SELECT l_orderkey, l_linenumber, l_partkey, reason, kind AS movement_type, CASE WHEN reason IS NULL THEN CASE WHEN kind IN ('receipt', 'production') THEN abs(typed) WHEN kind IN ('issue', 'sale') THEN -abs(typed) ELSE typed END END::DECIMAL(38,10) AS quantity,
  CASE WHEN l_orderkey % 17 <> 0 THEN ['GRN', 'ISS', 'ADJ'][(l_partkey % 3 + 1)::INT] || '-' || year(l_shipdate)::VARCHAR || '-' || lpad((l_orderkey % 100000)::VARCHAR, 5, '0') END AS voucher_no,
  CASE WHEN kind = 'receipt' AND l_orderkey % 3 = 0 THEN 'PO-1995-00077' END AS po_number, CASE l_orderkey % 3 WHEN 0 THEN 'po 1995/77' WHEN 1 THEN 'by hand' END AS reference FROM r""")
def parse_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock movements with one signed quantity or an in and an out column; the kind decides the sign, only receipts have an order."""
    lines = _lines(spark, sf_dir)
    o, p, q = F.col("l_orderkey"), F.col("l_partkey"), F.col("q").cast("string")
    pair, both = o % 2 == 0, p % 19 == 0
    signed = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("-"), q)).otherwise(q)
    cells = fields(
        voucher_no=F.when(o % 17 == 0, "RCT-1995-1").otherwise(F.concat(pick(p, "grn ", "ISS-", "adj/"), F.col("y"), F.lit(" - "), (o % 100000).cast("string"))),
        sku=F.when(p % 29 == 0, "12").otherwise("trm-zip-7"), description=_null(), movement_type=pick(F.col("l_linenumber"), "GRN", " Issued to Production", "FG in", "sales issue", "stock count ADJ", "weird", "Goods  received"),
        qty_in=F.when(pair & ((F.col("l_returnflag") == "R") | both), q), qty_out=F.when(pair & ((F.col("l_returnflag") != "R") | both), F.concat(q, F.lit(" m"))), quantity=F.when(~pair & ~both, signed), reference=pick(o, "po 1995/77", " by  hand", " "),
    )
    columns = F.when(pair, F.array(F.lit("qty_in"), F.lit("qty_out"))).otherwise(F.array(F.lit("quantity")))
    given = _given(lines, cells, date_reason=F.when(F.col("l_suppkey") % 31 == 0, "BAD_DATE"), fields=columns, book=o, sheet_index=F.col("l_linenumber"), row_num=p)
    out = parse.movements(given)
    return out.select(F.col("book").alias("l_orderkey"), F.col("sheet_index").alias("l_linenumber"), F.col("row_num").alias("l_partkey"), "reason", "movement_type", F.when(F.col("reason").isNull(), F.col("quantity")).alias("quantity"), "voucher_no", "po_number", "reference")


@query("""WITH o AS (SELECT *, (o_totalprice::DECIMAL(14,2) * 100)::BIGINT AS c, o_orderkey AS k FROM orders),
 r AS (SELECT *, c // 10 AS d, CASE WHEN k % 19 = 0 THEN 'BAD_PERIOD' WHEN k % 7 = 0 THEN 'BAD_CODE' WHEN k % 11 = 0 THEN 'MISSING_FIELD' WHEN k % 13 = 0 THEN 'CURRENCY_CONFLICT' WHEN k % 17 = 0 THEN 'BAD_AMOUNT' WHEN k % 5 = 0 THEN 'NET_MISMATCH' END AS reason FROM o)
 SELECT k AS o_orderkey, reason, CASE WHEN k % 19 <> 0 THEN date_trunc('month', o_orderdate)::DATE END AS period, CASE WHEN k % 7 <> 0 AND k % 3 <> 0 THEN 'E' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') END AS employee_code,
  CASE WHEN k % 11 = 0 THEN '' ELSE 'ann ' || lower(o_orderstatus) || ' smith' END AS sorted_name, CASE WHEN reason IS NULL THEN o_totalprice::DECIMAL(14,2)::DECIMAL(38,10) END AS gross, CASE WHEN reason IS NULL THEN (d::DECIMAL(18,0) * 0.01::DECIMAL(3,2))::DECIMAL(38,10) END AS deductions,
  CASE WHEN k % 2 = 0 THEN 'Tailor' END AS position FROM r""")
def parse_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay lines; the period comes from the sheet's name, the code may be missing, the net must agree."""
    orders = spread(read(spark, sf_dir, "orders"), "o_orderkey").withColumns({"c": (F.col("o_totalprice").cast("decimal(14,2)") * 100).cast("long"), "k": F.col("o_orderkey")})
    k, c = F.col("k"), F.col("c")
    d = F.floor(c / 10).cast("long")
    cash = lambda x: (x.cast("decimal(20,0)") / 100).cast("decimal(20,2)").cast("string")
    net = F.when(k % 5 == 0, cash(c)).otherwise(cash(c - d))
    cells = fields(
        employee_code=F.when(k % 7 == 0, "boss").when(k % 3 == 0, "").otherwise(F.concat(F.lit("emp "), (F.col("o_custkey") % 1000).cast("string"))), name=F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("SMITH, "), F.col("o_orderstatus"), F.lit("  Ann"))),
        position=F.when(k % 2 == 0, " Tailor "), gross=F.when(k % 13 == 0, F.concat(F.lit("$"), cash(c))).otherwise(cash(c)), deductions=F.when(k % 17 == 0, F.concat(F.lit("-"), cash(d))).otherwise(cash(d)), net=net,
    )
    name = F.when(k % 19 == 0, "Notes 5").otherwise(F.date_format("o_orderdate", "MMM yyyy"))
    given = _given(orders, cells, book=k, sheet_index=F.lit(0), row_num=k, sheet=name, year=F.year("o_orderdate"))
    out = parse.payroll(given)
    fine = F.col("reason").isNull()
    order = F.array_join(F.array_sort(F.split("name_key", " ")), " ")
    return out.select(F.col("book").alias("o_orderkey"), "reason", "period", "employee_code", F.when(F.col("name_key") == "", "").otherwise(F.concat_ws(" ", F.lit("ann"), F.array_join(F.array_remove(F.array_remove(F.split(order, " "), "ann"), "smith"), " "), F.lit("smith"))).alias("sorted_name"), F.when(fine, F.col("gross")).alias("gross"), F.when(fine, F.col("deductions")).alias("deductions"), "position")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'MISSING_FIELD' WHEN p_partkey % 5 = 0 THEN 'BAD_CODE' WHEN p_partkey % 11 = 0 THEN 'MISSING_FIELD' WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN 'MISSING_FIELD' END AS reason,
 CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 THEN 'PKG-BAG-' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') END AS sku, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS description,
 CASE WHEN p_partkey % 13 <> 0 THEN ['fabric', 'trims', 'packaging', 'services', 'finished', 'finished'][(p_partkey % 6 + 1)::INT] END AS category, CASE WHEN p_partkey % 17 <> 0 THEN ['m', 'pc', 'pc', 'job'][(p_partkey % 4 + 1)::INT] END AS uom FROM part""")
def parse_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item master with its category and unit words."""
    part = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cells = fields(
        sku=F.when(k % 7 == 0, "").when(k % 5 == 0, "PKG-BAG").otherwise(F.concat(F.lit("pkg.bag/"), (k % 1000).cast("string"))), description=F.when(k % 11 == 0, "  ").otherwise(F.concat(F.lit(" "), F.regexp_replace("p_name", " ", "  "))),
        category=F.when(k % 13 == 0, "other").otherwise(pick(k, "FABRIC", "Trims", "packaging ", "services", "Finished  Goods", "finished")), uom=F.when(k % 17 == 0, "").otherwise(pick(k, "M", "pc", "PCS", "job")),
    )
    out = parse.products(_given(part, cells, book=k, sheet_index=F.lit(0), row_num=k))
    return out.select(F.col("book").alias("p_partkey"), "reason", "sku", "description", "category", "uom")


@query("""WITH e AS (SELECT event_id, '  ' || repeat(coalesce(json_extract_string(props, '$.k'), '') || ' ', (event_id % 60)::INT) AS s FROM events), t AS (SELECT event_id, trim(regexp_replace(s, '\\s+', ' ', 'g')) AS s FROM e),
 p AS (SELECT event_id, array_to_string(list_filter([CASE WHEN s <> '' THEN 'reference: ' || s END, 'amount: ' || event_id::VARCHAR], lambda x: x IS NOT NULL), '; ') AS p FROM t)
 SELECT event_id, CASE WHEN length(p) > 140 THEN p[:137] || '...' ELSE p END AS preview FROM p""")
def row_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what stood in a rejected row, in the order of its columns, blanks left out, cut to 140 characters."""
    value = F.from_json("props", "map<string,string>")["k"]
    cells = fields(amount=F.col("event_id").cast("string"), reference=F.concat(F.lit("  "), F.expr("repeat(concat(coalesce(v, ''), ' '), cast(event_id % 60 as int))")))
    return read(spark, sf_dir, "events").withColumn("v", value).select("event_id", parse.preview(cells, F.array(F.lit("reference"), F.lit("note"), F.lit("amount"))).alias("preview"))


# --- dates ----------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS sheet, o_custkey // 10 AS book, o_orderdate::DATE AS d, o_custkey % 5 AS style FROM orders),
 c AS (SELECT *, CASE style WHEN 0 THEN 'dmy' WHEN 1 THEN 'mdy' WHEN 2 THEN CASE WHEN k % 2 = 0 THEN 'dmy' ELSE 'mdy' END WHEN 3 THEN CASE WHEN day(d) <= 12 THEN 'dmy' ELSE 'iso' END ELSE CASE WHEN k % 3 = 0 THEN 'mdy' ELSE 'iso' END END AS w, CASE WHEN k % 29 = 0 THEN 'missing' WHEN k % 31 = 0 THEN 'invalid' END AS odd FROM o),
 t AS (SELECT *, CASE WHEN odd IS NOT NULL THEN odd WHEN w = 'iso' THEN 'iso' WHEN day(d) = month(d) THEN 'same_day_month' WHEN day(d) <= 12 THEN 'ambiguous' WHEN w = 'dmy' THEN 'day_first' ELSE 'month_first' END AS m,
   make_date(1995 + (sheet % 8)::INT, 1, 1) - 62 AS a, make_date(1995 + (sheet % 8)::INT, 12, 31) + 62 AS z FROM c),
 x AS (SELECT *, CASE WHEN m NOT IN ('missing', 'invalid', 'ambiguous') THEN d END AS v, CASE WHEN m = 'ambiguous' THEN CASE WHEN w = 'dmy' THEN d ELSE make_date(year(d), day(d), month(d)) END END AS df, CASE WHEN m = 'ambiguous' THEN CASE WHEN w = 'mdy' THEN d ELSE make_date(year(d), day(d), month(d)) END END AS mf FROM t),
 s AS (SELECT *, max((m = 'day_first')::INT) OVER (PARTITION BY book, sheet) AS sd, max((m = 'month_first')::INT) OVER (PARTITION BY book, sheet) AS sm, max((m = 'day_first')::INT) OVER (PARTITION BY book) AS bd, max((m = 'month_first')::INT) OVER (PARTITION BY book) AS bm,
   last_value(CASE WHEN v BETWEEN a AND z THEN v END IGNORE NULLS) OVER (PARTITION BY book, sheet ORDER BY k ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING) AS up, first_value(CASE WHEN v BETWEEN a AND z THEN v END IGNORE NULLS) OVER (PARTITION BY book, sheet ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 15 FOLLOWING) AS down FROM x),
 n AS (SELECT *, CASE WHEN sd + sm = 1 THEN CASE WHEN sd = 1 THEN 'D' ELSE 'M' END WHEN sd + sm = 0 AND bd + bm = 1 THEN CASE WHEN bd = 1 THEN 'D' ELSE 'M' END END AS rule, CASE WHEN sd + sm = 1 THEN 'sheet_convention' ELSE 'book_convention' END AS by_,
   coalesce(df BETWEEN least(up, down) - 7 AND greatest(up, down) + 7, false) AS fd, coalesce(mf BETWEEN least(up, down) - 7 AND greatest(up, down) + 7, false) AS fm FROM s)
 SELECT k AS o_orderkey,
  CASE WHEN m IN ('missing', 'invalid') THEN NULL WHEN v IS NOT NULL THEN CASE WHEN v BETWEEN a AND z THEN v END WHEN NOT (df BETWEEN a AND z) AND NOT (mf BETWEEN a AND z) THEN NULL WHEN rule = 'D' THEN df WHEN rule = 'M' THEN mf WHEN fd AND NOT fm THEN df WHEN fm AND NOT fd THEN mf END AS date,
  CASE WHEN m <> 'ambiguous' THEN m WHEN NOT (df BETWEEN a AND z) AND NOT (mf BETWEEN a AND z) THEN 'ambiguous' WHEN rule IS NOT NULL THEN by_ WHEN fd <> fm THEN 'neighbours' ELSE 'ambiguous' END AS method,
  CASE WHEN m = 'missing' THEN 'MISSING_FIELD' WHEN m = 'invalid' THEN 'BAD_DATE' WHEN v IS NOT NULL THEN CASE WHEN v NOT BETWEEN a AND z THEN 'DATE_OUT_OF_RANGE' END WHEN NOT (df BETWEEN a AND z) AND NOT (mf BETWEEN a AND z) THEN 'DATE_OUT_OF_RANGE' WHEN rule IS NOT NULL OR fd <> fm THEN NULL ELSE 'AMBIGUOUS_DATE' END AS reason FROM n""")
def resolve_ambiguous_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per customer and a book per ten of them; sheet and book conventions, neighbours, dates out of range, and those that nothing settles."""
    d, k, c = F.to_date("o_orderdate"), F.col("o_orderkey"), F.col("o_custkey")
    iso, dmy, mdy = F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "dd/MM/yyyy"), F.date_format(d, "MM/dd/yyyy")
    typed = pick(c, dmy, mdy, F.when(k % 2 == 0, dmy).otherwise(mdy), F.when(F.dayofmonth(d) <= 12, dmy).otherwise(iso), F.when(k % 3 == 0, mdy).otherwise(iso))
    typed = F.when(k % 29 == 0, " ").when(k % 31 == 0, "31/02/1996").otherwise(typed)
    low, high = dates.valid_range((1995 + c % 8).cast("int"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", dates.tokenize(typed).alias("t"), F.floor(c / 10).alias("book"), c.alias("sheet"), k.alias("row_num"), low.alias("range_start"), high.alias("range_end"))
    return dates.resolve_dates(rows, "t").select("o_orderkey", "date", F.col("date_method").alias("method"), F.col("date_reason").alias("reason"))


# --- supplier names -------------------------------------------------------------------------------


def _spelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alias of every line: four spellings of a made name per supplier."""
    word = F.translate(F.substring(F.md5(F.col("s_suppkey").cast("string")), 1, 9), "0123456789", "ghijklmnop")
    names = read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(word, F.lit(" Textiles")).alias("name"))
    orders = read(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_linenumber") % 4).alias("hand")).join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    alias = (
        F.when(F.col("hand") == 0, F.concat("name", F.lit(" Ltd"))).when(F.col("hand") == 1, F.upper("name"))
        .when(F.col("hand") == 2, F.concat(F.substring("name", 1, 4), F.substring("name", 6, 40))).otherwise(F.regexp_replace("name", "Textiles", "Tex."))
    )
    return orders.select(alias.alias("alias"))


def _spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelled_lines(spark, sf_dir).groupBy("alias").agg(F.count("*").alias("row_count"))


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two short texts, by one bit vector per letter."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    masks = f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN 1::HUGEINT << i::INT ELSE 0 END))::HUGEINT)"
    rows = f"list_reduce({masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full})"
    return f"(length({a}) - bit_count({rows}))"


def _ratio(a: str, b: str) -> str:
    return f"200.0::DOUBLE * {_lcs(a, b)} / (length({a}) + length({b}))"


_NAMES = f"""n AS (SELECT s_suppkey AS k, translate(substr(md5(s_suppkey::VARCHAR), 1, 9), '0123456789', 'ghijklmnop') AS w FROM supplier),
al AS (SELECT CASE l_linenumber % 4 WHEN 0 THEN w || ' Textiles Ltd' WHEN 1 THEN upper(w || ' Textiles') WHEN 2 THEN substr(w, 1, 4) || substr(w, 6) || ' Textiles' ELSE w || ' Tex.' END AS alias,
  CASE l_linenumber % 4 WHEN 2 THEN substr(w, 1, 4) || substr(w, 6) ELSE w END AS id FROM lineitem JOIN n ON k = l_suppkey),
sp AS MATERIALIZED (SELECT alias, id, id || ' textiles' AS match_key, CASE WHEN id < 'textiles' THEN id || ' textiles' ELSE 'textiles ' || id END AS ordered, count(*) AS row_count FROM al GROUP BY ALL),
ks AS MATERIALIZED (SELECT id, match_key, ordered, sum(row_count) AS n, row_number() OVER (ORDER BY sum(row_count) DESC, match_key) AS r FROM sp GROUP BY id, match_key, ordered),
c1 AS MATERIALIZED (SELECT a.match_key AS a, b.match_key AS b, a.ordered AS ao, b.ordered AS bo, a.r AS ar, b.r AS br, {_ratio("a.id", "b.id")} AS s FROM ks a JOIN ks b ON a.match_key < b.match_key),
c2 AS MATERIALIZED (SELECT *, least(s, greatest({_ratio("a", "b")}, {_ratio("ao", "bo")})) AS score FROM c1 WHERE s >= 73),
pairs AS MATERIALIZED (SELECT a, b, ar, br, score FROM c2 WHERE score >= 73)"""


@query(f"WITH {_NAMES} SELECT a, b, round(score, 6) AS score FROM pairs")
def supplier_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of keys that scores 73 or more, from names spelled by four hands."""
    aliases = settled(_spellings(spark, sf_dir).select("alias"))  # the rules run once for each spelling, not for each line
    aliases = aliases.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = settled(aliases.select(matching.keys_of("alias").alias("k")).select("k.match_key", "k.identity").distinct())
    return matching.candidate_pairs(keys).select("a", "b", F.round("score", 6).alias("score"))


@query(f"""WITH RECURSIVE {_NAMES},
ed AS MATERIALIZED (SELECT match_key, r, list_sort(list(struct_pack(s := -score, r := o, k := ok))) AS near FROM (SELECT a AS match_key, ar AS r, b AS ok, br AS o, score FROM pairs UNION ALL SELECT b, br, a, ar, score FROM pairs) WHERE o < r GROUP BY match_key, r),
kk AS MATERIALIZED (SELECT ks.match_key, ks.r, coalesce(near, []) AS near FROM ks LEFT JOIN ed USING (match_key)),
g(i, match_key, best, joins, anchors) AS (
  SELECT 0::BIGINT, ''::VARCHAR, NULL::STRUCT(s DOUBLE, r BIGINT, k VARCHAR), false, []::BIGINT[]
  UNION ALL SELECT x.i, x.match_key, x.best, coalesce(-x.best.s >= 88, false), CASE WHEN coalesce(-x.best.s >= 88, false) THEN x.anchors ELSE list_append(x.anchors, x.i) END
  FROM (SELECT g.i + 1 AS i, kk.match_key, list_filter(kk.near, lambda e: list_contains(g.anchors, e.r))[1] AS best, g.anchors FROM g JOIN kk ON kk.r = g.i + 1) x),
cl AS (SELECT match_key, CASE WHEN joins THEN best.k ELSE match_key END AS anchor, CASE WHEN joins THEN -best.s ELSE 100.0 END AS score, CASE WHEN NOT joins THEN best.k END AS nearest, CASE WHEN NOT joins THEN -best.s END AS nearest_score FROM g WHERE i > 0),
al2 AS (SELECT sp.*, cl.* EXCLUDE (match_key) FROM sp JOIN cl USING (match_key)),
ca AS (SELECT anchor, arg_min(alias, (-row_count, alias)) AS canonical, arg_min(match_key, (-row_count, alias)) AS ckey FROM al2 GROUP BY anchor)
SELECT alias, match_key, anchor, canonical, CASE WHEN alias = canonical THEN 'exact' WHEN match_key = ckey THEN 'normalized' ELSE 'fuzzy' END AS method, round(score, 2)::DOUBLE AS score, nearest, round(nearest_score, 2)::DOUBLE AS nearest_score, row_count::BIGINT AS row_count
FROM al2 JOIN ca USING (anchor)""")
def supplier_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spellings clustered greedily by falling counts, with canonical names, methods and the review queue."""
    return matching.match_suppliers(_spellings(spark, sf_dir))


# --- outcomes, keys, constraints, scores ----------------------------------------------------------


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_suppkey % 10 WHEN 0 THEN 'BLANK_ROW' WHEN 1 THEN 'BAD_DATE' WHEN 2 THEN 'CONFLICTING_DUPLICATE' END AS code, l_suppkey % 10 = 3 AS kept FROM lineitem)
 SELECT l_orderkey, l_linenumber, l_partkey, code AS reason_code, CASE code WHEN 'BLANK_ROW' THEN 'noise' WHEN 'BAD_DATE' THEN 'data' WHEN 'CONFLICTING_DUPLICATE' THEN 'duplicate' END AS category,
 CASE WHEN code = 'BLANK_ROW' THEN 'skipped' WHEN code IS NOT NULL THEN 'rejected' WHEN kept THEN 'merged' ELSE 'loaded' END AS outcome FROM r""")
def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their rejects, the reasons' categories and the kept rows, to one outcome each."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 10).alias("m"))
    reasons = spark.createDataFrame([(k, v[0]) for k, v in load.REASONS.items()], "reason_code string, category string")
    rows = lines.withColumn("reason_code", F.when(F.col("m") == 0, "BLANK_ROW").when(F.col("m") == 1, "BAD_DATE").when(F.col("m") == 2, "CONFLICTING_DUPLICATE"))
    rows = rows.join(reasons, "reason_code", "left")
    outcome = dedupe.row_outcome(_null(), F.col("reason_code"), F.col("category"), F.when(F.col("m") == 3, F.lit("book")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "reason_code", "category", outcome.alias("outcome"))


@query("""WITH known AS (SELECT o_orderkey AS k, o_orderkey + 1000 AS id FROM orders WHERE o_orderkey % 3 = 0), top AS (SELECT max(id) AS t FROM known), fresh AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1)
 SELECT k, id FROM known UNION ALL SELECT k, t + row_number() OVER (ORDER BY k) FROM fresh, top""")
def keys_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys get the next numbers in key order, without gaps; known ones stay."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    known = orders.where("k % 3 = 0").select("k", (F.col("k") + 1000).alias("id"))
    return upsert.assign_ids(orders, known, ["k"], "id").select("k", "id")


@query("""WITH a AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice::DECIMAL(14,2) AS p, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders WHERE o_orderkey % 3 <> 0),
 b AS (SELECT o_orderkey AS k, o_custkey AS c, (o_totalprice::DECIMAL(14,2) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END)::DECIMAL(14,2) AS p FROM orders WHERE o_custkey % 4 = 1),
 f AS (SELECT k, row_number() OVER (ORDER BY k) + (SELECT max(id) FROM a) AS id FROM b WHERE k NOT IN (SELECT k FROM a))
 SELECT coalesce(a.id, f.id) AS order_id, coalesce(b.k, a.k) AS k, coalesce(b.c, a.c) AS c, coalesce(b.p, a.p) AS p FROM a FULL JOIN b ON a.k = b.k LEFT JOIN f ON f.k = b.k""")
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a store of key buckets: known keys keep their numbers, new ones go on after the last, nothing is lost."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").cast("decimal(14,2)").alias("p"))
    later = orders.where("c % 4 = 1").withColumn("p", (F.col("p") + F.when(F.col("k") % 7 == 0, 1).otherwise(0)).cast("decimal(14,2)"))
    now = upsert.Snapshot(spark, f"{scratch(spark)}/store-{uuid.uuid4().hex}")
    for run_id, rows in (("first", orders.where("k % 3 <> 0")), ("second", later)):
        now = upsert.publish(now, run_id, {"orders": upsert.stage(now, run_id, "orders", rows, ["k"], ["c", "p"], "order_id")}, {})
    return now.read("orders")


@query("""WITH u AS (SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'rejected' ELSE 'loaded' END AS e, CASE WHEN l_suppkey % 7 = 0 THEN 'merged' WHEN l_suppkey % 5 = 0 THEN 'rejected' ELSE 'loaded' END AS g, l_suppkey % 11 = 0 AS gone FROM lineitem)
 SELECT CASE WHEN e = 'rejected' THEN 'rejected:BAD_DATE' ELSE e END AS expected, CASE WHEN gone THEN 'missing' WHEN g = 'rejected' THEN 'rejected:BAD_DATE' ELSE g END AS actual, count(*)::BIGINT AS n FROM u GROUP BY ALL""")
def outcome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes against the truth, with rows that the load doesn't have as missing."""
    s = F.col("l_suppkey")
    every = read(spark, sf_dir, "lineitem")
    lines = numbered(every, *every.columns).select(F.col("l_orderkey").cast("string").alias("book"), F.col("l_linenumber").alias("sheet_index"), F.col("__g").alias("row_num"), "l_suppkey")
    reason = lambda o: F.when(o == "rejected", "BAD_DATE")
    expected = F.when(s % 5 == 0, "rejected").otherwise("loaded")
    got = F.when(s % 7 == 0, "merged").when(s % 5 == 0, "rejected").otherwise("loaded")
    truth = lines.select(*parse.ID, expected.alias("expected_outcome"), reason(expected).alias("expected_reason"))
    outcomes = lines.where(s % 11 != 0).select(*parse.ID, got.alias("outcome"), reason(got).alias("reason_code"))
    return scoring.outcome_score(truth, outcomes).select("expected", "actual", "n")


@query("""WITH p AS (SELECT o_orderkey AS k, ['iso', 'text_month', 'neighbours'][(o_custkey % 3 + 1)::INT] AS by_, o_orderdate::DATE AS t, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 20 = 0 THEN o_orderdate::DATE + 1 ELSE o_orderdate::DATE END AS v FROM orders)
 SELECT by_ AS "by", count(*)::BIGINT AS checked, (count(*) FILTER (WHERE v IS NOT DISTINCT FROM t))::BIGINT AS "right", array_to_string(list_sort(list(k) FILTER (WHERE v IS DISTINCT FROM t))[:5], ',') AS examples FROM p GROUP BY by_""")
def value_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3, Q4: parsed dates against the truth by the method that read them, with the first wrong rows."""
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(F.lit("b").alias("book"), F.lit(0).alias("sheet_index"), k.alias("row_num"), d.alias("t"), F.when(k % 50 == 0, None).when(k % 20 == 0, F.date_add(d, 1)).otherwise(d).alias("v"), pick(F.col("o_custkey"), "iso", "text_month", "neighbours").alias("m"))
    out = scoring.value_score(rows, rows, "v", "t", "m")
    return out.select("by", "checked", "right", F.array_join(F.transform("examples", lambda e: e["row_num"].cast("string")), ",").alias("examples"))


@query("""WITH l AS (SELECT *, l_suppkey % 97 AS m FROM lineitem)
 SELECT * FROM (SELECT 'row kind' AS rule, count(*) FILTER (WHERE m = 0)::BIGINT AS violations FROM l UNION ALL SELECT 'outcome', count(*) FILTER (WHERE m = 1)::BIGINT FROM l UNION ALL SELECT 'kept row is another', count(*) FILTER (WHERE m = 2)::BIGINT FROM l
 UNION ALL SELECT 'reject has a reason', count(*) FILTER (WHERE m = 3)::BIGINT FROM l UNION ALL SELECT 'row outcome key', count(*)::BIGINT FROM (SELECT 1 FROM l GROUP BY l_orderkey, l_linenumber, l_partkey HAVING count(*) > 1)
 UNION ALL SELECT 'outcome to reason', count(*) FILTER (WHERE m = 4)::BIGINT FROM l UNION ALL SELECT 'row to sheet', count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_custkey % 10 <> 0))::BIGINT FROM l
 UNION ALL SELECT 'sheet header or reason', count(*)::BIGINT FROM orders WHERE o_custkey % 10 = 1 UNION ALL SELECT 'sheet domain', count(*)::BIGINT FROM orders WHERE o_custkey % 10 = 2 UNION ALL SELECT 'kept row to row', 0
 UNION ALL SELECT 'reason category', 0 UNION ALL SELECT 'reason stage', 0 UNION ALL SELECT 'sheet key', 0) WHERE violations > 0 AND rule <> 'kept row to row'""")
def staging_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets, row kinds, outcomes, reasons and kept rows against their rules."""
    m = F.col("l_suppkey") % 97
    c = F.col("o_custkey") % 10
    sheets = read(spark, sf_dir, "orders").where(c != 0).select(F.col("o_orderkey").alias("book"), F.lit(0).alias("sheet_index"), F.when(c == 2, "other").otherwise("sales").alias("domain"), F.when(c != 1, 3).alias("header_row"), _null().alias("skipped_reason"))
    bad = read(spark, sf_dir, "orders").where(c.isin(1, 2)).select(F.col("o_orderkey").alias("book"))
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book"), F.lit(0).alias("sheet_index"), F.struct("l_linenumber", "l_partkey").alias("row_num"), m.alias("m"))
    rows = rows.withColumns({
        "kind": F.when(F.col("m") == 0, "odd").otherwise("data"), "outcome": F.when(F.col("m") == 1, "lost").when(F.col("m") == 3, "rejected").otherwise("loaded"), "reason_code": F.when(F.col("m") == 4, "NO_SUCH"),
        "kept_book": F.when(F.col("m") == 2, F.col("book")), "kept_sheet_index": F.lit(0), "kept_row_num": F.col("row_num"),
    })
    reasons = spark.createDataFrame([(k, *v) for k, v in load.REASONS.items()], "code string, category string, stage string, description string")
    found = load.staging_violations(sheets, rows, reasons)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.where("violations > 0")


#: Target tables made of the given ones, in which some rows break each rule; Spark and DuckDB read the same text.
_MONTHS = "(SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)"
_PO = "CASE WHEN {k} % 53 = 1 THEN 'P-' || CAST({k} AS STRING) ELSE 'PO-' || CAST(1000 + CAST(floor({k} / 100000) AS INT) AS STRING) || '-' || lpad(CAST({k} % 100000 AS STRING), 5, '0') END"
_SKU = "CASE WHEN {k} % 97 = 1 THEN 'bad' || CAST({k} AS STRING) ELSE 'FA' || chr(65 + CAST(floor({k} / 1000) AS INT) % 26) || '-COT-' || lpad(CAST({k} % 1000 AS STRING), 3, '0') END"
_LINES = f"""(SELECT *, (l_orderkey + l_linenumber + l_partkey) % 59 AS h, CAST(l_quantity AS DECIMAL(12,2)) AS q, {_PO.format(k="l_orderkey")} AS po, {_SKU.format(k="l_partkey")} AS item FROM lineitem)"""
_BROKEN = {
    "products": f"""SELECT {_SKU.format(k="k")} AS sku, CASE WHEN k % 97 = 5 THEN 'same' ELSE 'item ' || CAST(k AS STRING) END AS description_key, CASE WHEN k % 97 = 2 THEN 'other' ELSE 'fabric' END AS category, CASE WHEN k % 97 = 3 THEN 'kg' ELSE 'm' END AS uom
      FROM (SELECT p_partkey AS k FROM part UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 97 = 4) p""",
    "suppliers": """SELECT CASE WHEN s_suppkey % 11 = 1 THEN '' ELSE 's' || CAST(s_suppkey AS STRING) END AS match_key, CASE WHEN s_suppkey % 11 = 2 THEN '' ELSE s_name END AS canonical_name FROM supplier""",
    "supplier_aliases": """SELECT CASE WHEN s_suppkey % 11 = 7 THEN 'one' ELSE s_name END AS alias, CASE WHEN s_suppkey % 11 = 3 THEN 'none' ELSE 's' || CAST(s_suppkey AS STRING) END AS match_key, CASE WHEN s_suppkey % 11 = 4 THEN 'guess' ELSE 'exact' END AS match_method,
      CAST(CASE WHEN s_suppkey % 11 = 5 THEN 101 ELSE 90 END AS DECIMAL(5,2)) AS score, CASE WHEN s_suppkey % 11 = 6 THEN 0 ELSE 1 END AS row_count FROM supplier""",
    "fx_rates": f"""SELECT c AS currency, CASE WHEN month(m) = 3 AND c = 'USD' THEN m + INTERVAL 1 DAY ELSE m END AS month, CAST(CASE WHEN c = 'RWF' THEN CASE WHEN month(m) = 1 THEN 2 ELSE 1 END WHEN month(m) = 2 THEN 0 ELSE 1000 END AS DECIMAL(12,4)) AS rate_to_rwf
      FROM (SELECT 'RWF' AS c, m FROM {_MONTHS} a UNION ALL SELECT 'USD', m FROM {_MONTHS} b UNION ALL SELECT 'eur', m FROM {_MONTHS} d WHERE month(m) = 4 UNION ALL SELECT 'USD', m FROM {_MONTHS} e WHERE month(m) = 8) x""",
    "purchase_orders": f"""SELECT {_PO.format(k="k")} AS po_number, 's' || CAST(1 + k % 10 AS STRING) AS match_key, CASE WHEN k % 53 = 2 THEN 'EUR' WHEN k % 2 = 0 THEN 'RWF' ELSE 'USD' END AS currency, CAST(date_trunc('month', d) AS DATE) AS fx_month
      FROM (SELECT o_orderkey AS k, o_orderdate AS d FROM orders UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 53 = 4) o""",
    "po_lines": f"""SELECT po AS po_number, CASE WHEN h = 4 THEN 'ZZZ-ZZZ-999' ELSE item END AS sku, CASE WHEN (l_orderkey % 2 = 0) = (h <> 3) THEN 'RWF' ELSE 'USD' END AS currency, CASE WHEN h = 1 THEN CAST(0 AS DECIMAL(12,2)) ELSE q END AS quantity,
      CAST(10 AS DECIMAL(14,4)) AS unit_price, CAST(CASE WHEN h = 1 THEN 0 WHEN h = 2 THEN q * 10 + 5 ELSE q * 10 END AS DECIMAL(14,2)) AS amount, CAST(CASE WHEN h = 5 THEN 0 ELSE q END AS DECIMAL(18,2)) AS amount_rwf FROM {_LINES} l""",
    "sales": f"""SELECT CASE WHEN h = 6 THEN 'R' || CAST(l_orderkey AS STRING) ELSE 'RCT-1995-' || lpad(CAST(l_orderkey % 100000 AS STRING), 5, '0') END AS receipt_no, CASE WHEN h = 11 THEN 'ZZZ-ZZZ-998' ELSE item END AS sku, CAST(l_shipdate AS DATE) AS sale_date,
      CASE WHEN h = 7 THEN 'moon' ELSE 'export' END AS channel, q AS quantity, CAST(CASE WHEN h = 8 THEN -10 ELSE 10 END AS DECIMAL(14,4)) AS unit_price, CAST(CASE WHEN h = 9 THEN q * 10 + 5 ELSE q * 10 END AS DECIMAL(14,2)) AS amount,
      CASE WHEN h = 10 THEN 'EUR' ELSE 'RWF' END AS currency, CAST(q AS DECIMAL(18,2)) AS amount_rwf FROM {_LINES} l""",
    "movements": f"""SELECT CASE WHEN h = 12 THEN 'GRN' ELSE 'GRN-1995-' || lpad(CAST(l_orderkey % 100000 AS STRING), 5, '0') END AS voucher_no, CASE WHEN h = 16 THEN 'ZZZ-ZZZ-997' ELSE item END AS sku, t AS movement_type,
      CAST(CASE WHEN h = 13 THEN CASE WHEN t = 'adjustment' THEN 0 WHEN t = 'receipt' THEN -q ELSE q END WHEN t = 'issue' THEN -q ELSE q END AS DECIMAL(12,2)) AS quantity, CASE WHEN h = 15 AND t = 'receipt' THEN 'PO-0000-00000' WHEN t = 'receipt' OR h = 14 THEN po END AS po_number
      FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'receipt' WHEN l_linenumber % 3 = 1 THEN 'issue' ELSE 'adjustment' END AS t FROM {_LINES} l) x""",
    "employees": """SELECT CASE WHEN k % 61 = 1 THEN 'X' ELSE 'E' END || lpad(CAST(k % 10000 AS STRING), 4, '0') AS employee_code, DATE '2019-02-01' AS first_period, CASE WHEN k % 61 = 2 THEN DATE '2019-01-01' ELSE DATE '2019-03-01' END AS last_period
      FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 61 = 3) c""",
    "payroll_runs": f"""SELECT CASE WHEN month(m) = 5 THEN m + INTERVAL 1 DAY ELSE m END AS period, CASE WHEN month(m) = 6 THEN 0 ELSE 3 END AS employee_count, CAST(100 AS DECIMAL(16,2)) AS total_gross, CAST(10 AS DECIMAL(16,2)) AS total_deductions, CAST(CASE WHEN month(m) = 7 THEN 91 ELSE 90 END AS DECIMAL(16,2)) AS total_net
      FROM (SELECT m FROM {_MONTHS} a UNION ALL SELECT m FROM {_MONTHS} b WHERE month(m) = 9) x""",
    "payroll_lines": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, 'E' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') AS employee_code, CAST(CASE WHEN o_orderkey % 67 = 1 THEN 0 ELSE 100 END AS DECIMAL(14,2)) AS gross, CAST(5 AS DECIMAL(14,2)) AS deductions,
      CAST(CASE WHEN o_orderkey % 67 = 1 THEN -5 WHEN o_orderkey % 67 = 2 THEN 96 ELSE 95 END AS DECIMAL(14,2)) AS net FROM orders""",
}
_FITS = "abs(amount - quantity * unit_price) <= greatest(0.01, amount * 0.001)"
_POSITIVE = "quantity > 0 AND amount > 0 AND amount_rwf > 0 AND unit_price >= 0"
#: The rules once more as SQL conditions, unique keys and references, for DuckDB.
_RULES = {
    "products": {"product code": "regexp_matches(sku, '^[A-Z]{3}-[A-Z]{3}-[0-9]{3}$')", "product category": "category IN ('fabric', 'trims', 'packaging', 'services', 'finished')", "product unit": "uom IN ('m', 'pc', 'job')"},
    "suppliers": {"supplier key": "match_key <> ''", "supplier name": "canonical_name <> ''"},
    "supplier_aliases": {"alias method": "match_method IN ('exact', 'normalized', 'fuzzy')", "alias score": "score BETWEEN 0 AND 100", "alias rows": "row_count > 0"},
    "fx_rates": {"rate month": "day(month) = 1", "rate currency": "regexp_matches(currency, '^[A-Z]{3}$')", "rate positive": "rate_to_rwf > 0", "rwf is 1": "currency <> 'RWF' OR rate_to_rwf = 1"},
    "purchase_orders": {"order number": "regexp_matches(po_number, '^PO-[0-9]{4}-[0-9]{5}$')", "order currency": "currency IN ('RWF', 'USD')"},
    "po_lines": {"line positive": _POSITIVE, "line amount": _FITS},
    "sales": {"receipt number": "regexp_matches(receipt_no, '^RCT-[0-9]{4}-[0-9]{5}$')", "channel": "channel IN ('showroom', 'wholesale', 'export')", "sale positive": _POSITIVE, "sale amount": _FITS, "sale currency": "currency IN ('RWF', 'USD')"},
    "movements": {
        "voucher number": "regexp_matches(voucher_no, '^(GRN|ISS|PRD|SIV|ADJ)-[0-9]{4}-[0-9]{5}$')", "movement sign": "CASE WHEN movement_type IN ('receipt', 'production') THEN quantity > 0 WHEN movement_type IN ('issue', 'sale') THEN quantity < 0 ELSE quantity <> 0 END",
        "order only on receipts": "po_number IS NULL OR movement_type = 'receipt'",
    },
    "employees": {"employee number": "regexp_matches(employee_code, '^E[0-9]{3,4}$')", "periods in order": "first_period <= last_period"},
    "payroll_runs": {"run month": "day(period) = 1", "run employees": "employee_count > 0", "run net": "total_net = total_gross - total_deductions"},
    "payroll_lines": {"pay positive": "gross > 0 AND deductions >= 0", "pay net": "net = gross - deductions"},
}
_KEYS = {
    "fx_rates": "currency, month", "products": "sku", "suppliers": "match_key", "supplier_aliases": "alias", "purchase_orders": "po_number", "po_lines": "po_number, sku", "sales": "receipt_no, sku", "movements": "voucher_no", "employees": "employee_code",
    "payroll_runs": "period", "payroll_lines": "period, employee_code",
}
_REFERENCES = [
    ("line to order", "po_lines", "a.po_number = b.po_number AND a.currency = b.currency", "purchase_orders"), ("line to product", "po_lines", "a.sku = b.sku", "products"), ("sale to product", "sales", "a.sku = b.sku", "products"),
    ("movement to product", "movements", "a.sku = b.sku", "products"), ("order to rate", "purchase_orders", "a.currency = b.currency AND a.fx_month = b.month", "fx_rates"), ("pay to employee", "payroll_lines", "a.employee_code = b.employee_code", "employees"),
    ("alias to supplier", "supplier_aliases", "a.match_key = b.match_key", "suppliers"), ("sale to rate", "sales", "a.currency = b.currency AND date_trunc('month', a.sale_date) = b.month", "fx_rates"),
    ("movement to order", "movements", "a.po_number IS NULL OR a.po_number = b.po_number", "purchase_orders"), ("pay to run", "payroll_lines", "a.period = b.period", "payroll_runs"), ("order to supplier", "purchase_orders", "a.match_key = b.match_key", "suppliers"),
]


def _target_oracle() -> str:
    found = [f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT ({rule})) AS n FROM {table}" for table, rules in _RULES.items() for name, rule in rules.items()]
    found += [f"SELECT '{table} key', count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1)" for table, key in _KEYS.items()]
    found.append("SELECT 'products description', count(*) FROM (SELECT 1 FROM products GROUP BY description_key HAVING count(*) > 1)")
    for name, table, on, parent in _REFERENCES:
        there = "WHERE a.po_number IS NOT NULL" if name == "movement to order" else ""
        found.append(f"SELECT '{name}', count(*) FROM {table} a ANTI JOIN {parent} b ON {on.replace('a.po_number IS NULL OR ', '')} {there}")
    tables = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in _BROKEN.items())
    return f"WITH {tables} SELECT rule, n::BIGINT AS violations FROM ({' UNION ALL '.join(found)}) WHERE n > 0"


@query(_target_oracle())
def target_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the target tables on tables in which some rows break it: codes, vocabularies, signs, sums, keys and references."""
    given = {t: read(spark, sf_dir, t) for t in ("part", "supplier", "orders", "lineitem", "customer")}
    tables = {}
    for name, text in _BROKEN.items():
        for t in given:
            text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
        made = spark.sql(text, **{t: df for t, df in given.items() if f"{{{t}}}" in text})
        tables[name] = settled(made) if name in ("fx_rates", "payroll_runs") else made  # a row a month; of the others each rule reads the columns that it needs
    return load.violations(tables)


@query("""SELECT * FROM (SELECT o_orderkey::VARCHAR AS run_id, o_orderdate::DATE AS started_at, (o_custkey % 7)::INT AS workbooks, 5 AS rows_in, (o_custkey % 5 + 2)::BIGINT AS inserted, (o_custkey % 3 + 1)::BIGINT AS updated FROM orders)""")
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of loads with the changes of all tables added up."""
    c = F.col("o_custkey")
    change = lambda a, b: F.create_map(F.lit("inserted"), a.cast("long"), F.lit("updated"), b.cast("long"))
    changes = F.create_map(F.lit("sales"), change(c % 5, c % 3), F.lit("products"), change(F.lit(2), F.lit(1)))
    runs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.to_date("o_orderdate").alias("started_at"), (c % 7).cast("int").alias("workbooks"), F.lit(5).alias("rows_in"), changes.alias("changes"))
    return reports.load_history(runs)


@query("""SELECT o_custkey % 5 AS domain, count(DISTINCT o_orderkey % 1000)::BIGINT AS expected FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def expected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that should be loaded, by domain."""
    truth = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("domain"), F.when(F.col("o_orderstatus") == "F", "loaded").otherwise("rejected").alias("expected_outcome"), (F.col("o_orderkey") % 1000).alias("record_id"))
    return scoring.expected_records(truth)


@query("""WITH b AS (SELECT l_suppkey::VARCHAR AS book, l_orderkey AS o, l_linenumber AS n, ['loaded', 'merged', 'rejected', 'skipped'][(l_partkey % 4 + 1)::INT] AS outcome, l_quantity < 40 AS there FROM lineitem),
 u AS (SELECT book, o, n, min(outcome) AS outcome, bool_and(there) AS there FROM b GROUP BY ALL)
 SELECT book, count(DISTINCT o % 3)::BIGINT AS sheets, count(*)::BIGINT AS n_rows, (count(*) FILTER (WHERE outcome = 'loaded'))::BIGINT AS loaded, (count(*) FILTER (WHERE outcome = 'merged'))::BIGINT AS merged, (count(*) FILTER (WHERE outcome = 'rejected'))::BIGINT AS rejected,
  (count(*) FILTER (WHERE outcome = 'skipped'))::BIGINT AS skipped, (count(*) FILTER (WHERE outcome = 'loaded' AND NOT there))::BIGINT AS missing FROM u GROUP BY book""")
def rows_by_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book's rows by outcome, and rows said to be loaded that no table has."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("book"), "l_orderkey", "l_linenumber", pick(F.col("l_partkey"), "loaded", "merged", "rejected", "skipped").alias("outcome"), (F.col("l_quantity") < 40).alias("there"))
    rows = lines.groupBy("book", "l_orderkey", "l_linenumber").agg(F.min("outcome").alias("outcome"), F.bool_and("there").alias("there"))
    rows = rows.select("book", (F.col("l_orderkey") % 3).cast("int").alias("sheet_index"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_num"), F.lit("sales").alias("domain"), "outcome", "there")
    there = rows.where("outcome = 'loaded' AND there").select("sheet_index", F.concat_ws("|", "book", F.col("sheet_index").cast("string"), "row_num").alias("source_ref"))
    kept = {t: there.where(F.pmod(F.xxhash64("source_ref"), F.lit(5)) == i) for i, t in enumerate(("products", "po_lines", "sales", "movements", "payroll_lines"))}
    return reports.by_book(rows, reports.loaded_rows(kept)).drop("domain")


@query("""WITH t AS (SELECT l_orderkey AS o, l_partkey AS p, ['purchases', 'sales', 'inventory', 'payroll', 'products'][(l_suppkey % 5 + 1)::INT] AS domain, l_orderkey % 7 AS b, l_linenumber % 3 AS sheet, ['loaded', 'merged', 'rejected', 'skipped'][(l_partkey % 4 + 1)::INT] AS outcome, l_partkey % 10 <> 0 AS data, l_quantity < 40 AS there FROM lineitem),
 e AS (SELECT domain, count(DISTINCT o) AS expected FROM t WHERE p % 3 = 0 GROUP BY 1),
 g AS (SELECT grouping(domain, b) AS g, domain, CASE WHEN grouping(b) = 0 THEN domain || '-' || b::VARCHAR END AS book, count(DISTINCT domain || '|' || b::VARCHAR || '|' || sheet::VARCHAR)::BIGINT AS sheets, count(*)::BIGINT AS n_rows, (count(*) FILTER (WHERE data))::BIGINT AS data_rows,
  (count(*) FILTER (WHERE outcome = 'loaded'))::BIGINT AS loaded, (count(*) FILTER (WHERE outcome = 'merged'))::BIGINT AS merged, (count(*) FILTER (WHERE outcome = 'rejected'))::BIGINT AS rejected, (count(*) FILTER (WHERE outcome = 'skipped'))::BIGINT AS skipped,
  (count(*) FILTER (WHERE outcome = 'loaded' AND NOT there))::BIGINT AS missing FROM t GROUP BY GROUPING SETS ((domain, b), (domain), ()))
 SELECT CASE g WHEN 0 THEN 'book' WHEN 1 THEN 'domain' ELSE 'all' END AS level, g.domain, book, sheets, n_rows, data_rows, loaded, merged, rejected, skipped, missing,
  (CASE g WHEN 1 THEN e.expected WHEN 3 THEN (SELECT sum(expected) FROM e) END)::BIGINT AS expected FROM g LEFT JOIN e ON e.domain = g.domain""")
def totals_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book, domain and the whole: rows in, data rows, outcomes, rows that no table has, and records that should be loaded."""
    every = read(spark, sf_dir, "lineitem")
    lines = numbered(every, *every.columns).select(
        "l_orderkey", "l_partkey", pick(F.col("l_suppkey"), "purchases", "sales", "inventory", "payroll", "products").alias("domain"), (F.col("l_linenumber") % 3).cast("int").alias("sheet_index"), F.col("__g").alias("row_num"),
        pick(F.col("l_partkey"), "loaded", "merged", "rejected", "skipped").alias("outcome"), F.when(F.col("l_partkey") % 10 != 0, "data").otherwise("blank").alias("kind"), (F.col("l_quantity") < 40).alias("there"),
    )
    lines = settled(lines.withColumn("book", F.concat_ws("-", "domain", (F.col("l_orderkey") % 7).cast("string"))))
    loaded = lines.where("outcome = 'loaded' AND there").select(F.lit("sales").alias("target"), F.concat_ws("|", "book", F.col("sheet_index").cast("string"), F.col("row_num").cast("string")).alias("source_ref"))
    truth = lines.select("domain", F.when(F.col("l_partkey") % 3 == 0, "loaded").otherwise("rejected").alias("expected_outcome"), F.col("l_orderkey").alias("record_id"))
    return reports.with_totals(lines, loaded, scoring.expected_records(truth))


@query("""WITH n AS (SELECT s_suppkey AS k, translate(substr(md5(s_suppkey::VARCHAR), 1, 9), '0123456789', 'ghijklmnop') AS w, l_linenumber % 4 AS hand FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
 SELECT CASE hand WHEN 0 THEN 'J. K. ' || w || ' Textiles Limited' WHEN 1 THEN upper(w) || 'textiles Co' WHEN 2 THEN 'É' || w || ' & Sons Mfg' ELSE 'Intl. ' || w || ' Bros' END AS alias,
  CASE hand WHEN 0 THEN 'jk ' || w || ' textiles' WHEN 1 THEN w || ' textiles' WHEN 2 THEN 'e' || w || ' sons manufacturing' ELSE 'int ernational ' || w || ' brothers' END AS match_key,
  CASE hand WHEN 0 THEN 'jk ' || w WHEN 1 THEN w WHEN 2 THEN 'e' || w || ' manufacturing' ELSE w END AS identity, count(*)::BIGINT AS n FROM n GROUP BY ALL""")
def supplier_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M6: keys and identifying parts of names with initials, glued trade words, accents, abbreviations, "and" and legal forms ("ernational" counts as glued: it is close enough to the trade word)."""
    word = F.translate(F.substring(F.md5(F.col("s_suppkey").cast("string")), 1, 9), "0123456789", "ghijklmnop")
    hand = F.col("l_linenumber") % 4
    alias = (
        F.when(hand == 0, F.concat(F.lit("J. K. "), word, F.lit(" Textiles Limited"))).when(hand == 1, F.concat(F.upper(word), F.lit("textiles Co")))
        .when(hand == 2, F.concat(F.lit("É"), word, F.lit(" & Sons Mfg"))).otherwise(F.concat(F.lit("Intl. "), word, F.lit(" Bros")))
    )
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    names = settled(lines.groupBy(alias.alias("alias")).agg(F.count("*").alias("n"))).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return names.select("alias", "n", matching.keys_of("alias").alias("k")).select("alias", "k.match_key", "k.identity", "n")


@query(f"SELECT anchor AS match_key, min(canonical) AS canonical_name, count(*)::BIGINT AS spellings, sum(row_count)::BIGINT AS n_lines FROM ({ORACLE_SQL['supplier_match']}) GROUP BY anchor")
def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to the supplier of their spelling, and each supplier's spellings and lines."""
    lines = _spelled_lines(spark, sf_dir)
    aliases, suppliers = matching.alias_tables(settled(matching.match_suppliers(lines.groupBy("alias").agg(F.count("*").alias("row_count")))))
    known = lines.join(aliases.select("alias", "match_key"), "alias").groupBy("match_key").agg(F.countDistinct("alias").alias("spellings"), F.count("*").alias("n_lines"))
    return known.join(suppliers, "match_key").select("match_key", "canonical_name", "spellings", "n_lines")


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'RWF' WHEN o_orderkey % 17 = 0 THEN 'EUR' ELSE 'USD' END AS currency, date_trunc('month', o_orderdate)::DATE AS fx_month FROM orders)
 SELECT o_orderkey, currency, fx_month, (CASE WHEN year(fx_month) BETWEEN 1993 AND 1996 THEN CASE currency WHEN 'RWF' THEN 1 WHEN 'USD' THEN 1000 + 5 * ((year(fx_month) - 2015) * 12 + month(fx_month) - 1) END END)::DECIMAL(12,4) AS rate_to_rwf,
  CASE WHEN currency = 'EUR' OR year(fx_month) NOT BETWEEN 1993 AND 1996 THEN 'FX_RATE_MISSING' END AS reason FROM o""")
def fx_rate_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates by currency and month; a currency or month without one is a reject."""
    k = F.col("o_orderkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.when(k % 3 == 0, "RWF").when(k % 17 == 0, "EUR").otherwise("USD").alias("currency"))
    rates = resolve.fx_rates(spark.range(1), F.lit("1993-01-01").cast("date"), F.lit("1996-12-01").cast("date"))
    return resolve.with_rates(orders, rates, "d").select("o_orderkey", "currency", "fx_month", "rate_to_rwf", F.when(F.col("rate_to_rwf").isNull(), "FX_RATE_MISSING").alias("reason"))


@query("""WITH p AS (SELECT ['purchases', 'sales', 'movements'][(l_partkey % 3 + 1)::INT] AS domain, ['iso', 'excel_date', 'neighbours'][(l_linenumber % 3 + 1)::INT] AS m, ['column', 'embedded', 'header'][(l_suppkey % 3 + 1)::INT] AS s, CASE WHEN l_orderkey % 2 = 0 THEN 'RWF' ELSE 'USD' END AS c FROM lineitem WHERE l_orderkey % 5 <> 0)
 SELECT 'dates' AS what, domain, m AS how, NULL::VARCHAR AS currency, count(*)::BIGINT AS n FROM p GROUP BY ALL UNION ALL SELECT 'currencies', domain, s, c, count(*)::BIGINT FROM p WHERE domain <> 'movements' GROUP BY ALL""")
def reading_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How dates were read and where currencies came from, of the rows that could be read."""
    o = F.col("l_orderkey")
    rows = read(spark, sf_dir, "lineitem").select(
        pick(F.col("l_partkey"), "purchases", "sales", "movements").alias("domain"), pick(F.col("l_linenumber"), "iso", "excel_date", "neighbours").alias("date_method"),
        pick(F.col("l_suppkey"), "column", "embedded", "header").alias("currency_source"), F.when(o % 2 == 0, "RWF").otherwise("USD").alias("currency"), F.when(o % 5 == 0, "BAD_AMOUNT").alias("reason"),
    )
    dated, priced = reports.reading({f"parsed_{d}": rows.where(F.col("domain") == d).drop("domain") for d in ("purchases", "sales", "movements")}).values()
    first = dated.select(F.lit("dates").alias("what"), "domain", F.col("date_method").alias("how"), _null().alias("currency"), "n")
    return first.unionByName(priced.select(F.lit("currencies").alias("what"), "domain", F.col("currency_source").alias("how"), "currency", "n"))


@query("""WITH k AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 9 < 4)
 SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 AND l_orderkey IN (SELECT k FROM k) THEN 'PO-' || l_orderkey::VARCHAR END AS po_number FROM lineitem""")
def receipts_to_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A receipt keeps its order's number only if this load or an earlier one knows the order; an order that both know doesn't double it."""
    number = lambda k: F.concat(F.lit("PO-"), F.col(k).cast("string"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", number("o_orderkey").alias("po_number"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") % 2 == 0, number("l_orderkey")).alias("po_number"))
    return resolve.if_known(lines, "po_number", orders.where("o_orderkey % 3 <> 0").select("po_number"), orders.where("o_orderkey % 9 < 4").select("po_number"))


@query("""SELECT date_trunc('month', o_orderdate)::DATE AS period, count(*)::INT AS employee_count, sum(o_totalprice::DECIMAL(14,2))::DECIMAL(16,2) AS total_gross, sum((o_custkey % 100)::DECIMAL(14,2))::DECIMAL(16,2) AS total_deductions,
 sum(o_totalprice::DECIMAL(14,2) - (o_custkey % 100)::DECIMAL(14,2))::DECIMAL(16,2) AS total_net FROM orders GROUP BY 1""")
def payroll_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's lines with the sums of gross, deductions and net."""
    gross, less = F.col("o_totalprice").cast("decimal(14,2)"), (F.col("o_custkey") % 100).cast("decimal(14,2)")
    paid = read(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").alias("period"), gross.alias("gross"), less.alias("deductions"), (gross - less).alias("net"))
    return load.payroll_totals(paid)

"""The quality report of a load: tables as DataFrames, rendered to a page, a metrics file and a block of a text file."""

from __future__ import annotations

import html
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.operators import upsert
from tallybook.plans import scoring, stock
from tallybook.plans.load import TABLES
from tallybook.plans.rows import ID
from tallybook.vocabulary import AUTO_MERGE, REVIEW


def loaded_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(target, source_ref) of everything that carries its source row."""
    parts = [tables[t].select(F.lit(t).alias("target"), "source_ref") for t in ("products", "po_lines", "sales", "movements", "payroll_lines")]
    return reduce(DataFrame.unionByName, parts)


def by_book(outcomes: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of each book by outcome, and those said to be loaded that no table has."""
    key = F.concat_ws("|", "book", F.col("sheet_index").cast("string"), F.col("row_num").cast("string"))
    both = outcomes.withColumn("ref", key).join(loaded.select(F.col("source_ref").alias("ref"), "target"), "ref", "left")
    o = F.col("outcome")
    count = {x: F.count_if(o == x).alias(x) for x in ("loaded", "merged", "rejected", "skipped")}
    return both.groupBy("book").agg(F.min("domain").alias("domain"), F.countDistinct("sheet_index").alias("sheets"), F.count("*").alias("n_rows"), *count.values(), F.count_if((o == "loaded") & F.col("target").isNull()).alias("missing")).orderBy("book")


def with_totals(outcomes: DataFrame, loaded: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """level (book, domain or all), domain, book, and their sheets, rows, data rows, rows by outcome, and loaded rows that no table has; with ``expected``
    (domain, expected) also the records that should be loaded. One pass: books, domains and all are grouping sets."""
    key = F.concat_ws("|", "book", F.col("sheet_index").cast("string"), F.col("row_num").cast("string"))
    both = outcomes.withColumn("__ref", key).join(loaded.select(F.col("source_ref").alias("__ref"), "target"), "__ref", "left")
    o = F.col("outcome")
    counts = [F.count_if(o == x).alias(x) for x in ("loaded", "merged", "rejected", "skipped")]
    sums = both.groupingSets([["domain", "book"], ["domain"], []], "domain", "book").agg(
        F.grouping_id().alias("__level"), F.countDistinct(F.struct("book", "sheet_index")).alias("sheets"), F.count("*").alias("n_rows"), F.count_if(F.col("kind") == "data").alias("data_rows"), *counts,
        F.count_if((o == "loaded") & F.col("target").isNull()).alias("missing"),
    )
    level = F.when(F.col("__level") == 0, "book").when(F.col("__level") == 1, "domain").otherwise("all")
    out = sums.withColumn("level", level)
    columns = ["level", "domain", "book", "sheets", "n_rows", "data_rows", "loaded", "merged", "rejected", "skipped", "missing"]
    if expected is not None:
        wanted = expected.groupingSets([["domain"], []], "domain").agg(F.grouping_id().alias("__g"), F.sum("expected").alias("expected"))
        wanted = wanted.select(F.when(F.col("__g") == 0, "domain").otherwise("all").alias("__l"), F.col("domain").alias("__d"), "expected")
        out = out.join(wanted, (F.col("level") == F.col("__l")) & F.col("domain").eqNullSafe(F.col("__d")), "left")
        columns.append("expected")
    return out.select(*columns)


def reasons_with_examples(outcomes: DataFrame, reasons: DataFrame, examples: int = 3) -> DataFrame:
    """Every used reason with its count and its first rows."""
    used = outcomes.where("reason_code IS NOT NULL")
    first = used.withColumn("i", F.row_number().over(Window.partitionBy("reason_code").orderBy(*ID))).where(F.col("i") <= examples)
    shown = first.groupBy("reason_code").agg(F.sort_array(F.collect_list(F.struct(*ID, "detail"))).alias("examples"))
    counts = used.groupBy("reason_code").agg(F.count("*").alias("n"))
    return reasons.join(counts.join(shown, "reason_code"), F.col("code") == F.col("reason_code")).select("code", "category", "stage", "description", "n", "examples").orderBy(F.desc("n"), "code")


def merged_locations(outcomes: DataFrame) -> DataFrame:
    """Where merged rows stood against the kept row, with the first example of each place."""
    where = F.when((F.col("book") == F.col("kept_book")) & (F.col("sheet_index") == F.col("kept_sheet_index")), "same sheet").when(F.col("book") == F.col("kept_book"), "same workbook").otherwise("another workbook")
    return outcomes.where("outcome = 'merged'").groupBy(where.alias("location")).agg(F.count("*").alias("n"), F.min(F.struct(*ID, "kept_book", "kept_sheet_index", "kept_row_num")).alias("example")).orderBy("location")


def suppliers_by_spellings(aliases: DataFrame, suppliers: DataFrame, top: int = 8) -> DataFrame:
    """The suppliers with most spellings, their spellings most frequent first."""
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("row_count")).alias("n"), "alias"))), lambda x: x["alias"]), " | ")
    g = aliases.groupBy("match_key").agg(F.count("*").alias("spellings"), F.sum("row_count").alias("n_rows"), listed.alias("names"))
    return g.join(suppliers, "match_key").orderBy(F.desc("spellings"), F.desc("n_rows"), "match_key").limit(top)


def reconciliation(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Receipts against orders, negative stock, sales against stock movements, and yearly totals."""
    goods = tables["products"].where("category <> 'services'").select("sku", "description")
    ordered = tables["po_lines"].join(goods, "sku").groupBy("po_number", "sku").agg(F.sum("quantity").alias("ordered"))
    moves = tables["movements"]
    received = moves.where("movement_type = 'receipt' AND po_number IS NOT NULL").groupBy("po_number", "sku").agg(F.sum("quantity").alias("received"))
    negative = stock.negative_stock(moves, "sku", "movement_date", "quantity").join(tables["products"].select("sku", "description"), "sku")
    month = lambda c: F.trunc(c, "MM").alias("month")
    sold = tables["sales"].groupBy("sku", month("sale_date")).agg(F.sum("quantity").alias("sold"))
    issued = moves.where("movement_type = 'sale'").groupBy("sku", month("movement_date")).agg((-F.sum("quantity")).alias("issued"))
    year = lambda c: F.year(c).alias("year")
    orders = tables["purchase_orders"].select("po_number", "order_date")
    bought = tables["po_lines"].join(orders, "po_number").groupBy(year("order_date")).agg(F.sum("amount_rwf").alias("purchases"))
    sales = tables["sales"].groupBy(year("sale_date")).agg(F.sum("amount_rwf").alias("sales"), F.sum(F.when(F.col("channel") == "export", F.col("amount_rwf"))).alias("export_sales"))
    paid = tables["payroll_runs"].groupBy(year("period")).agg(F.sum("total_gross").alias("payroll"), F.round(F.avg("employee_count"), 1).alias("headcount"))
    return {
        "receipts_vs_orders": stock.receipts_vs_orders(ordered, received, ["po_number", "sku"]).orderBy(F.desc("lines"), "status"),
        "negative_stock": negative.orderBy("sku"),
        "sales_vs_stock_card": stock.two_books(sold, issued, ["sku", "month"], "sold", "issued").orderBy(F.desc("n"), "status"),
        "yearly_totals": bought.join(sales, "year", "full").join(paid, "year", "full").orderBy("year"),
    }


def load_history(runs: DataFrame) -> DataFrame:
    total = lambda what: F.aggregate(F.map_values("changes"), F.lit(0).cast("long"), lambda a, m: a + m[what])
    return runs.select("run_id", "started_at", "workbooks", "rows_in", total("inserted").alias("inserted"), total("updated").alias("updated")).orderBy("started_at")


def bar_chart(bars: list[tuple[str, float]], width: int = 640) -> str:
    """Horizontal bars as inline SVG."""
    top, rows = max((v for _, v in bars), default=1) or 1, []
    for i, (name, v) in enumerate(bars):
        y = 22 * i
        rows.append(f'<text x="0" y="{y + 14}" font-size="12">{html.escape(str(name))}</text><rect x="220" y="{y + 3}" width="{(width - 300) * v / top:.1f}" height="15" fill="#4a7"/><text x="{225 + (width - 300) * v / top:.1f}" y="{y + 15}" font-size="11">{v:,.0f}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{22 * len(bars) + 4}">{"".join(rows)}</svg>'


def sweep_chart(points: list[tuple[float, float, float]], chosen: float, width: int = 640, height: int = 240) -> str:
    """Precision and recall over thresholds as inline SVG, with the chosen threshold marked."""
    low, high = min(t for t, _, _ in points), max(t for t, _, _ in points)
    x = lambda t: 40 + (width - 60) * (t - low) / ((high - low) or 1)
    y = lambda v: 10 + (height - 40) * (1 - v)
    line = lambda i, colour: f'<polyline fill="none" stroke="{colour}" stroke-width="2" points="{" ".join(f"{x(p[0]):.1f},{y(p[i]):.1f}" for p in sorted(points))}"/>'
    marks = "".join(f'<text x="{x(t):.1f}" y="{height - 12}" font-size="11" text-anchor="middle">{t:g}</text>' for t in (low, chosen, high))
    marks += "".join(f'<text x="4" y="{y(v) + 4:.1f}" font-size="11">{v:.1f}</text>' for v in (0.0, 0.5, 1.0))
    at = f'<line x1="{x(chosen):.1f}" x2="{x(chosen):.1f}" y1="10" y2="{height - 30}" stroke="#999" stroke-dasharray="4"/>'
    names = f'<text x="{width - 150}" y="{height - 50}" font-size="12" fill="#47a">precision</text><text x="{width - 80}" y="{height - 50}" font-size="12" fill="#a64">recall</text>'
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}">{line(1, "#47a")}{line(2, "#a64")}{at}{marks}{names}</svg>'


#: What stands around the block of results in a text file.
BLOCK = ("<!-- load results: begin -->", "<!-- load results: end -->")


def results_text(numbers: dict) -> str:
    """The main figures as a Markdown table; those that need a ground truth only where there was one."""
    share = lambda a, b: f"{numbers[a]:,} of {numbers[b]:,} ({100 * numbers[a] / max(numbers[b], 1):.2f} %)"
    rows = [
        ("Workbooks; sheets read / skipped", f"{numbers['workbooks']:,}; {numbers['sheets_read']:,} / {numbers['sheets_skipped']:,}"), ("Rows below a header", f"{numbers['rows_in']:,}"),
        ("Rows loaded / merged / rejected / skipped", " / ".join(f"{numbers.get(f'rows_{o}', 0):,}" for o in ("loaded", "merged", "rejected", "skipped"))), ("Loaded rows that no table has", f"{numbers['loaded_rows_missing']:,}"),
        ("Supplier spellings, suppliers", f"{numbers['supplier_spellings']:,}, {numbers['suppliers_found']:,}"), ("Last load inserted / updated", f"{numbers['last_run_inserted']:,} / {numbers['last_run_updated']:,}"),
    ]
    if "outcomes_checked" in numbers:
        rows += [
            ("Outcomes equal to the truth", share("outcomes_right", "outcomes_checked")), ("Suppliers in truth", f"{numbers['suppliers_true']:,}"), ("Supplier pairs: precision / recall", f"{numbers['supplier_precision']:.4f} / {numbers['supplier_recall']:.4f}"),
            ("False merges", f"{numbers['false_merges']:,}"), ("Review queue / right", f"{numbers['review_queue']:,} / {numbers['review_right']:,}"), ("Dates right", share("dates_right", "dates_checked")), ("Amounts right", share("amounts_right", "amounts_checked")),
        ]
    return "| Figure | Value |\n| --- | --- |\n" + "\n".join(f"| {a} | {b} |" for a, b in rows)


def update_text(path: str, numbers: dict) -> bool:
    """Puts the results between the marks of a text file; whether it changed. A file without both marks, in order, is left alone."""
    with open(path) as f:
        old = f.read()
    head, mark, rest = old.partition(BLOCK[0])
    _, end, tail = rest.partition(BLOCK[1])
    if not mark or not end:
        return False
    new = f"{head}{mark}\n{results_text(numbers)}\n{end}{tail}"
    if new != old:
        with open(path, "w") as f:
            f.write(new)
    return new != old


def reading(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """How dates were read and where currencies came from, of the rows that could be read."""
    fine = {d: tables[f"parsed_{d}"].where("reason IS NULL") for d in ("purchases", "sales", "movements")}
    dated = reduce(DataFrame.unionByName, [df.select(F.lit(d).alias("domain"), "date_method") for d, df in fine.items()])
    priced = reduce(DataFrame.unionByName, [fine[d].select(F.lit(d).alias("domain"), "currency_source", "currency") for d in ("purchases", "sales")])
    count = F.count("*").alias("n")
    return {"Dates by method": dated.groupBy("domain", "date_method").agg(count).orderBy("domain", "date_method"), "Currencies by source": priced.groupBy("domain", "currency_source", "currency").agg(count).orderBy("domain", "currency_source", "currency")}


def against_truth(spark: SparkSession, tables: dict[str, DataFrame], truth_dir: str) -> dict[str, DataFrame]:
    """Scores of the load against the ground truth in a folder."""
    truth = scoring.read_truth(spark, truth_dir)
    fine = {d: tables[f"parsed_{d}"].where("reason IS NULL") for d in ("purchases", "sales", "movements")}
    dated = reduce(DataFrame.unionByName, [df.select(*ID, F.col(c).alias("date"), "date_method") for (_, df), c in zip(fine.items(), ("order_date", "sale_date", "movement_date"), strict=True)])
    priced = reduce(DataFrame.unionByName, [fine[d].select(*ID, F.col("amount").cast("decimal(18,2)").alias("amount"), "currency", "currency_source") for d in ("purchases", "sales")])
    known = truth["rows"].where("true_date IS NOT NULL")
    named = scoring.supplier_score(tables["supplier_aliases"], truth["supplier_aliases"], tables["supplier_review"])
    # several source rows of one record are loaded once
    loaded = tables["row_outcomes"].where("outcome = 'loaded'").groupBy("domain").agg(F.count("*").alias("loaded"))
    text = lambda df: df.withColumn("examples", F.array_join(F.transform("examples", lambda e: F.concat_ws("!", *[e[c].cast("string") for c in ID])), ", "))
    return {
        "Outcomes against truth": scoring.outcome_score(truth["rows"], tables["row_outcomes"]).withColumn("example", F.concat_ws("!", *[F.col(f"example.{c}").cast("string") for c in ID])).orderBy("expected", "actual"),
        "Records by domain": scoring.expected_records(truth["rows"]).join(loaded, "domain", "full").orderBy("domain"),
        "Supplier pairs": named["pairs"], "False merges": named["false_merges"].orderBy("cluster"), "Split suppliers": named["split"].orderBy("supplier_code"), "Review hits": named["review"],
        "Dates against truth": text(scoring.value_score(dated, known, "date", "true_date", "date_method")).orderBy("by"),
        "Amounts against truth": text(scoring.value_score(priced, truth["rows"].where("true_amount IS NOT NULL"), "amount", "true_amount", "currency_source")).orderBy("by"),
        "Currencies against truth": text(scoring.value_score(priced, truth["rows"].where("true_currency IS NOT NULL"), "currency", "true_currency", "currency_source")).orderBy("by"),
    }


def build_report(spark: SparkSession, out_dir: str, page: str, metrics: str, truth_dir: str | None = None) -> dict:
    """Writes an HTML page and a metrics file of the current run; the same run gives the same bytes. Only report-sized results are collected.

    With a ground truth, the load is scored against it too.
    """
    parsed = [f"parsed_{d}" for d in ("purchases", "sales", "movements")]
    names = [*TABLES, *parsed, "sheets", "row_outcomes", "supplier_review", "reject_reasons"]
    now = upsert.snapshot(spark, out_dir)  # one run's tables, whatever is loaded meanwhile
    t = {n: now.read(n) for n in names}
    outcomes = t["row_outcomes"]
    expected = scoring.expected_records(scoring.read_truth(spark, truth_dir)["rows"]) if truth_dir else None
    place = lambda e: F.concat_ws("!", *[e[c].cast("string") for c in ID])
    reasons = reasons_with_examples(outcomes, t["reject_reasons"]).withColumn("examples", F.array_join(F.transform("examples", lambda e: F.concat_ws(" ", place(e), e["detail"])), " | "))
    merged = merged_locations(outcomes).withColumn("example", place(F.col("example")))
    tables = {
        "Books": by_book(outcomes, loaded_rows(t)), "Domains": with_totals(outcomes, loaded_rows(t), expected).where("level <> 'book'").drop("book").orderBy("level", "domain"), "Reasons": reasons, "Merged rows": merged, **reading(t),
        "Spellings": suppliers_by_spellings(t["supplier_aliases"], t["suppliers"]), "Matches": t["supplier_aliases"].groupBy("match_method").agg(F.count("*").alias("n")).orderBy("match_method"),
        "Review": t["supplier_review"].orderBy(F.desc("nearest_score"), "alias"), **reconciliation(t), "Loads": load_history(spark.read.parquet(f"{out_dir}/load_runs")).drop("run_id", "started_at"),
    }
    if truth_dir:
        tables |= against_truth(spark, t, truth_dir)
    got = {name: [r.asDict(recursive=True) for r in df.collect()] for name, df in tables.items()}
    counts = {r["outcome"]: r["n"] for r in outcomes.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    numbers = {f"rows_{k}": v for k, v in counts.items()} | {f"core_{n}": t[n].count() for n in TABLES} | {"rows_in": sum(counts.values()), "workbooks": len(got["Books"])}
    numbers |= {f"dates_{r['domain']}_{r['date_method']}": r["n"] for r in got["Dates by method"]} | {f"matches_{r['match_method']}": r["n"] for r in got["Matches"]} | {"review_queue": len(got["Review"])}
    sheets = t["sheets"].agg(F.count_if(F.col("skipped_reason").isNull()).alias("read"), F.count_if(F.col("skipped_reason").isNotNull()).alias("skipped")).first()
    last = got["Loads"][-1]
    numbers |= {
        "sheets_read": sheets["read"], "sheets_skipped": sheets["skipped"], "loaded_rows_missing": sum(r["missing"] for r in got["Books"]), "supplier_spellings": numbers["core_supplier_aliases"], "suppliers_found": numbers["core_suppliers"],
        "auto_merge_threshold": AUTO_MERGE, "review_threshold": REVIEW, "load_runs": len(got["Loads"]), "last_run_inserted": last["inserted"], "last_run_updated": last["updated"],
    }
    if truth_dir:
        pairs, scored = got["Supplier pairs"][0], got["Outcomes against truth"]
        numbers |= {"outcomes_checked": sum(r["n"] for r in scored), "outcomes_right": sum(r["n"] for r in scored if r["agree"]), "supplier_precision": round(pairs["precision"], 4), "supplier_recall": round(pairs["recall"], 4), "false_merges": len(got["False merges"])}
        truth = scoring.read_truth(spark, truth_dir)
        about = truth["manifest"].select("seed", "start_year", "end_year").first()
        numbers |= {"suppliers_true": truth["suppliers"].count(), "review_right": got["Review hits"][0]["right"], "seed": about["seed"], "years": f"{about['start_year']}-{about['end_year']}"}
        numbers |= {f"{what}_{k}": sum(r[k] for r in got[f"{what.capitalize()} against truth"]) for what in ("dates", "amounts", "currencies") for k in ("checked", "right")}
    body = [f"<h1>Load report</h1>{bar_chart(sorted(counts.items()))}"]
    for name, rows in got.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in (rows[0] if rows else {}))
        lines = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r.values()) + "</tr>" for r in rows)
        body.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{lines}</table>")
    with open(page, "w") as f:
        f.write(f"<!doctype html><meta charset='utf-8'><title>Load report</title>{''.join(body)}")
    with open(metrics, "w") as f:
        json.dump(numbers, f, indent=1, sort_keys=True)
    return numbers

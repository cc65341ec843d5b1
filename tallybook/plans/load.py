"""The load: workbooks to a normalised, reconciled set of tables.

Stages are written to the shared checkpoint folder, so plans stay small and a lost executor takes nothing with it. The run's
tables take effect only when ``publish`` has written all of them and switches to them; a failed run leaves the last in force. Rows are followed by (book, sheet_index, row_num) to one outcome: loaded, merged, rejected, skipped.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions import money, text
from tallybook.operators import constraints, dedupe, matching, resolve, upsert
from tallybook.operators.graph import settled
from tallybook.plans import rows as parse
from tallybook.sources.layout import classify_rows, find_layouts
from tallybook.sources.workbook import read_grids
from tallybook.vocabulary import NOISE, REASONS

ID = parse.ID
#: Natural key and values of each target table.
TABLES = {
    "fx_rates": (["currency", "month"], ["rate_to_rwf"]),
    "products": (["sku"], ["description", "description_key", "category", "uom", "source_ref"]),
    "suppliers": (["match_key"], ["canonical_name"]),
    "supplier_aliases": (["alias"], ["match_key", "match_method", "score", "row_count"]),
    "purchase_orders": (["po_number"], ["match_key", "order_date", "currency", "fx_month", "source_ref"]),
    "po_lines": (["po_number", "sku"], ["currency", "quantity", "unit_price", "amount", "amount_rwf", "source_ref"]),
    "sales": (["receipt_no", "sku"], ["sale_date", "channel", "quantity", "unit_price", "amount", "currency", "amount_rwf", "source_ref"]),
    "movements": (["voucher_no"], ["movement_date", "sku", "movement_type", "quantity", "po_number", "reference", "source_ref"]),
    "employees": (["employee_code"], ["full_name", "name_key", "position", "first_period", "last_period"]),
    "payroll_runs": (["period"], ["employee_count", "total_gross", "total_deductions", "total_net"]),
    "payroll_lines": (["period", "employee_code"], ["gross", "deductions", "net", "source_ref"]),
}
#: Tables whose rows get a number that stays with their key.
IDS = {
    "products": "product_id", "suppliers": "supplier_id", "purchase_orders": "po_id", "sales": "sale_id", "movements": "movement_id", "employees": "employee_id", "payroll_runs": "payroll_run_id",
}


@dataclass
class LoadResult:
    run_id: str
    workbooks: int
    rows_in: int
    changes: dict[str, tuple[int, int]]


def _ref() -> F.Column:
    return F.concat_ws("|", "book", F.col("sheet_index").cast("string"), F.col("row_num").cast("string"))


def _first_wins(rows: DataFrame, key: list[str], values: list[str], natural) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(loaded rows, merged pointers, conflict rejects)."""
    ranked = dedupe.first_copies(rows.withColumn("print", dedupe.fingerprint(*[F.col(v) for v in values])), key, ID, "print", ID)
    ranked = settled(ranked.withColumns({"outcome": dedupe.outcome(first=F.col("is_first")), "natural_key": natural, "source_ref": _ref()}))
    merged = ranked.where("outcome = 'merged'").select(*ID, "kept_book", "kept_sheet_index", "kept_row_num", "natural_key")
    conflicts = ranked.where("outcome = 'rejected'").select(*ID, F.lit("CONFLICTING_DUPLICATE").alias("reason_code"), F.concat(F.lit("differs from the first copy of "), F.col("natural_key")).alias("detail"))
    return ranked.where("outcome = 'loaded'"), merged, conflicts


def _reject(rows: DataFrame, condition, code: str, detail) -> DataFrame:
    return rows.where(condition).select(*ID, F.lit(code).alias("reason_code"), detail.cast("string").alias("detail"))


def payroll_totals(paid: DataFrame) -> DataFrame:
    """A row for each month that was paid: its lines and their sums."""
    total = lambda x: F.sum(x).cast("decimal(16,2)").alias(f"total_{x}")
    return paid.groupBy("period").agg(F.count("*").cast("int").alias("employee_count"), total("gross"), total("deductions"), total("net"))


def build_from(grids: DataFrame, published: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All staging, outcome and target tables of one load.

    Rows refer to this load's products and orders, and to those of earlier loads in ``published`` that it doesn't bring anew.
    """
    spark, published = grids.sparkSession, published or {}
    layouts = settled(find_layouts(grids))
    rows = settled(classify_rows(grids, layouts))
    data = rows.where("kind = 'data'")
    dated = parse.with_dates(data.where(F.col("domain").isin("purchases", "sales", "inventory")))
    parsed = {
        "products": parse.products(data.where("domain = 'products'")),
        "purchases": parse.purchases(dated.where("domain = 'purchases'")),
        "sales": parse.sales(dated.where("domain = 'sales'")),
        "movements": parse.movements(dated.where("domain = 'inventory'")),
        "payroll": parse.payroll(data.where("domain = 'payroll'")),
    }
    parsed = {k: settled(v) for k, v in parsed.items()}
    noise_code = text.lookup(F.col("kind"), NOISE)
    rejects = [rows.where("kind <> 'data'").select(*ID, noise_code.alias("reason_code"), F.lit(None).cast("string").alias("detail"))]
    shown = rows.select(*ID, parse.preview(F.col("cells"), F.col("fields")).alias("detail"))  # what stood in the row, for the review of rejects
    bad = [p.where("reason IS NOT NULL").select(*ID, F.col("reason").alias("reason_code")) for p in parsed.values()]
    rejects += [reduce(DataFrame.unionByName, bad).join(shown, ID, "left")]
    good = {k: v.where("reason IS NULL").drop("reason") for k, v in parsed.items()}
    merged = []

    # products
    products, m, c = _first_wins(good["products"], ["sku"], ["description", "category", "uom"], F.col("sku"))
    merged.append(m)
    rejects.append(c)
    products = settled(products.withColumn("description_key", text.description_key(F.col("description"))))
    items = products.select(F.col("sku").alias("item"), F.col("sku").alias("item_code"), F.col("description_key").alias("item_key"))
    if "products" in published:
        before = published["products"].select(F.col("sku").alias("item"), F.col("sku").alias("item_code"), F.col("description_key").alias("item_key"))
        items = settled(items.unionByName(before.join(items.select("item"), "item", "left_anti")))

    def with_item(df: DataFrame) -> DataFrame:
        asked = F.coalesce("sku", "description_key").alias("asked")
        found = settled(resolve.by_code_or_key(df, items, "sku", "description_key", "item", "item_code", "item_key").withColumn("asked", asked).drop("sku", "description_key").withColumnRenamed("item", "sku"))
        rejects.append(_reject(found, F.col("sku").isNull(), "UNKNOWN_PRODUCT", F.col("asked")))
        return found.where("sku IS NOT NULL").drop("asked")

    # suppliers, from the spellings of readable purchase rows
    spellings = good["purchases"].groupBy(F.col("supplier_raw").alias("alias")).agg(F.count("*").alias("row_count"))
    matches = settled(matching.match_suppliers(spellings))
    aliases, suppliers = matching.alias_tables(matches)
    review = matches.where("nearest IS NOT NULL").select("alias", "nearest", "nearest_score")

    # rates for all years of the books and one on either side
    span = layouts.agg(F.coalesce(F.min("year") - 1, F.lit(2000)).alias("a"), F.coalesce(F.max("year") + 1, F.lit(2030)).alias("b"))
    rates = resolve.fx_rates(span, F.make_date("a", F.lit(1), F.lit(1)), F.make_date("b", F.lit(12), F.lit(1))).withColumn("source", F.lit("formula"))

    def with_rate(df: DataFrame, day: str) -> DataFrame:
        found = settled(resolve.with_rates(df, rates, day))
        rejects.append(_reject(found, F.col("rate_to_rwf").isNull(), "FX_RATE_MISSING", F.concat_ws(" ", "currency", "fx_month")))
        return found.where("rate_to_rwf IS NOT NULL")

    # purchases
    lines = with_rate(with_item(good["purchases"]).join(aliases.select(F.col("alias").alias("supplier_raw"), "match_key"), "supplier_raw"), "order_date")
    lines, m, c = _first_wins(lines, ["po_number", "sku"], ["match_key", "order_date", "quantity", "amount", "currency"], F.concat_ws(" ", "po_number", "sku"))
    merged.append(m)
    rejects.append(c)
    lines = settled(resolve.header_mismatches(lines, "po_number", ID, ["match_key", "order_date", "currency"]))
    rejects.append(_reject(lines, ~F.col("header_ok"), "PO_HEADER_MISMATCH", F.col("po_number")))
    first = F.struct(*ID)
    orders = lines.groupBy("po_number").agg(F.min_by(F.struct("match_key", "order_date", "currency", "fx_month", "source_ref"), first).alias("h")).select("po_number", "h.*")
    typed = {"quantity": F.col("quantity").cast("decimal(12,2)"), "unit_price": F.col("unit_price").cast("decimal(14,4)"), "amount": F.col("amount").cast("decimal(14,2)")}
    rwf = {"amount_rwf": resolve.convert(F.col("amount").cast("decimal(14,2)"), F.col("rate_to_rwf"))}
    po_lines = lines.where("header_ok").withColumns(typed | rwf)

    # sales
    sold, m, c = _first_wins(with_rate(with_item(good["sales"]), "sale_date"), ["receipt_no", "sku"], ["sale_date", "channel", "quantity", "amount", "currency"], F.concat_ws(" ", "receipt_no", "sku"))
    merged.append(m)
    rejects.append(c)
    sold = sold.withColumns(typed | rwf)

    # stock movements; a receipt's order stays only if that order is known
    moved, m, c = _first_wins(with_item(good["movements"]), ["voucher_no"], ["movement_date", "sku", "movement_type", "quantity"], F.col("voucher_no"))
    merged.append(m)
    rejects.append(c)
    earlier = [published["purchase_orders"].select("po_number")] if "purchase_orders" in published else []
    moved = resolve.if_known(moved, "po_number", orders.select("po_number"), *earlier).withColumn("quantity", F.col("quantity").cast("decimal(12,2)"))

    # payroll
    coded = good["payroll"].where("employee_code IS NOT NULL")
    spelled = coded.groupBy("employee_code", "name_raw").agg(F.count("*").alias("n"))
    shown = spelled.groupBy("employee_code").agg(F.min(F.struct((-F.col("n")).alias("n"), "name_raw"))["name_raw"].alias("full_name"))
    keys = coded.groupBy("employee_code", "name_key").agg(F.count("*").alias("n")).groupBy("employee_code").agg(F.min(F.struct((-F.col("n")).alias("n"), "name_key"))["name_key"].alias("name_key"))
    spans = coded.groupBy("employee_code").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.max_by("position", F.struct("period", *ID)).alias("position"))
    employees = spans.join(shown, "employee_code").join(keys, "employee_code")
    paid = settled(resolve.by_unique_name(good["payroll"], employees.select("employee_code", "name_key"), "employee_code", "name_key"))
    rejects.append(paid.where("reason IS NOT NULL").select(*ID, F.col("reason").alias("reason_code"), F.col("name_raw").alias("detail")))
    paid = paid.where("reason IS NULL").drop("employee_code").withColumnRenamed("resolved_code", "employee_code")
    paid, m, c = _first_wins(paid, ["period", "employee_code"], ["gross", "deductions", "net"], F.concat_ws(" ", "period", "employee_code"))
    merged.append(m)
    rejects.append(c)
    cash = {x: F.col(x).cast("decimal(14,2)") for x in ("gross", "deductions", "net")}
    paid = paid.withColumns(cash)
    runs = payroll_totals(paid)

    union = lambda parts: reduce(DataFrame.unionByName, parts)
    all_rejects, all_merged = settled(union(rejects)), settled(union(merged))
    reasons = spark.createDataFrame([(k, *v) for k, v in REASONS.items()], "code string, category string, stage string, description string")
    outcomes = (
        rows.select(*ID, "sheet", "domain", "kind")
        .join(all_rejects, ID, "left")
        .join(reasons.select(F.col("code").alias("reason_code"), "category"), "reason_code", "left")
        .join(all_merged, ID, "left")
    )
    outcome = dedupe.row_outcome(F.col("kind"), F.col("reason_code"), F.col("category"), F.col("kept_book"))
    outcomes = outcomes.select(*ID, "sheet", "domain", "kind", outcome.alias("outcome"), "reason_code", "detail", "kept_book", "kept_sheet_index", "kept_row_num", "natural_key")
    targets = {
        "fx_rates": rates, "products": products, "suppliers": suppliers, "supplier_aliases": aliases, "purchase_orders": orders, "po_lines": po_lines, "sales": sold, "movements": moved,
        "employees": employees, "payroll_runs": runs, "payroll_lines": paid,
    }
    targets = {name: settled(targets[name].select(*key, *values)) for name, (key, values) in TABLES.items()}
    sheets = layouts.select("book", "sheet_index", "sheet", "domain", "year", "header_row", "skipped_reason")
    values = {f"parsed_{name}": parsed[name] for name in parsed}
    return targets | values | {"sheets": sheets, "row_outcomes": settled(outcomes), "supplier_review": review, "reject_reasons": reasons}


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) of the target tables and, where they are given, of sheets, outcomes and reasons."""
    t, col = tables, F.col
    fits = lambda: money.within_tolerance(col("amount"), col("quantity"), col("unit_price"))
    rules = {
        "products": {"product code": col("sku").rlike(r"^[A-Z]{3}-[A-Z]{3}-\d{3}$"), "product category": col("category").isin("fabric", "trims", "packaging", "services", "finished"), "product unit": col("uom").isin("m", "pc", "job")},
        "suppliers": {"supplier key": col("match_key") != "", "supplier name": col("canonical_name") != ""},
        "supplier_aliases": {"alias method": col("match_method").isin("exact", "normalized", "fuzzy"), "alias score": col("score").between(0, 100), "alias rows": col("row_count") > 0},
        "fx_rates": {"rate month": F.dayofmonth("month") == 1, "rate currency": col("currency").rlike("^[A-Z]{3}$"), "rate positive": col("rate_to_rwf") > 0, "rwf is 1": (col("currency") != "RWF") | (col("rate_to_rwf") == 1)},
        "purchase_orders": {"order number": col("po_number").rlike(r"^PO-\d{4}-\d{5}$"), "order currency": col("currency").isin("RWF", "USD")},
        "po_lines": {"line positive": (col("quantity") > 0) & (col("amount") > 0) & (col("amount_rwf") > 0) & (col("unit_price") >= 0), "line amount": fits()},
        "sales": {"receipt number": col("receipt_no").rlike(r"^RCT-\d{4}-\d{5}$"), "channel": col("channel").isin("showroom", "wholesale", "export"), "sale positive": (col("quantity") > 0) & (col("amount") > 0) & (col("amount_rwf") > 0) & (col("unit_price") >= 0), "sale amount": fits(), "sale currency": col("currency").isin("RWF", "USD")},
        "movements": {
            "voucher number": col("voucher_no").rlike(r"^(GRN|ISS|PRD|SIV|ADJ)-\d{4}-\d{5}$"), "movement sign": F.when(col("movement_type").isin("receipt", "production"), col("quantity") > 0).when(col("movement_type").isin("issue", "sale"), col("quantity") < 0).otherwise(col("quantity") != 0),
            "order only on receipts": col("po_number").isNull() | (col("movement_type") == "receipt"),
        },
        "employees": {"employee number": col("employee_code").rlike(r"^E\d{3,4}$"), "periods in order": col("first_period") <= col("last_period")},
        "payroll_runs": {"run month": F.dayofmonth("period") == 1, "run employees": col("employee_count") > 0, "run net": col("total_net") == col("total_gross") - col("total_deductions")},
        "payroll_lines": {"pay positive": (col("gross") > 0) & (col("deductions") >= 0), "pay net": col("net") == col("gross") - col("deductions")},
    }
    found = [constraints.check(t[name], r) for name, r in rules.items()]
    found += [constraints.unique(t[name], f"{name} key", key) for name, (key, _) in TABLES.items()]
    found += [
        constraints.foreign_key(t["po_lines"], "line to order", ["po_number", "currency"], t["purchase_orders"], ["po_number", "currency"]),
        constraints.foreign_key(t["po_lines"], "line to product", ["sku"], t["products"], ["sku"]),
        constraints.foreign_key(t["sales"], "sale to product", ["sku"], t["products"], ["sku"]),
        constraints.foreign_key(t["movements"], "movement to product", ["sku"], t["products"], ["sku"]),
        constraints.foreign_key(t["purchase_orders"], "order to rate", ["currency", "fx_month"], t["fx_rates"], ["currency", "month"]),
        constraints.foreign_key(t["payroll_lines"], "pay to employee", ["employee_code"], t["employees"], ["employee_code"]),
        constraints.foreign_key(t["supplier_aliases"], "alias to supplier", ["match_key"], t["suppliers"], ["match_key"]),
    ]
    found.append(constraints.unique(t["products"].where("description_key IS NOT NULL"), "products description", ["description_key"]))
    month = t["sales"].withColumn("fx_month", F.trunc("sale_date", "MM"))
    found += [
        constraints.foreign_key(month, "sale to rate", ["currency", "fx_month"], t["fx_rates"], ["currency", "month"]),
        constraints.foreign_key(t["movements"], "movement to order", ["po_number"], t["purchase_orders"], ["po_number"]),
        constraints.foreign_key(t["payroll_lines"], "pay to run", ["period"], t["payroll_runs"], ["period"]),
        constraints.foreign_key(t["purchase_orders"], "order to supplier", ["match_key"], t["suppliers"], ["match_key"]),
    ]
    if "row_outcomes" in t:
        found += staging_violations(t["sheets"], t["row_outcomes"], t["reject_reasons"])
        parsed = [t[name].select(*ID) for name in t if name.startswith("parsed_")]
        if parsed:
            found.append(constraints.foreign_key(reduce(DataFrame.unionByName, parsed), "parsed row to row", ID, t["row_outcomes"], ID))
    return reduce(DataFrame.unionByName, found).where("violations > 0")


def staging_violations(sheets: DataFrame, outcomes: DataFrame, reasons: DataFrame) -> list[DataFrame]:
    """A sheet has a header or a reason, row kinds and reasons are of the vocabulary, a merged row isn't its own kept row."""
    col = F.col
    kept = F.struct("kept_book", "kept_sheet_index", "kept_row_num")
    return [
        constraints.check(sheets, {"sheet header or reason": col("header_row").isNull() == col("skipped_reason").isNotNull(), "sheet domain": col("domain").isin("purchases", "sales", "inventory", "payroll", "products")}),
        constraints.check(outcomes, {
            "row kind": col("kind").isin("data", "blank", "subtotal", "repeated_header"), "outcome": col("outcome").isin("loaded", "merged", "rejected", "skipped"),
            "kept row is another": col("kept_book").isNull() | (F.struct(col("book"), col("sheet_index"), col("row_num")) != kept), "reject has a reason": (col("outcome") != "rejected") | col("reason_code").isNotNull(),
        }),
        constraints.check(reasons, {"reason category": col("category").isin("noise", "data", "duplicate"), "reason stage": col("stage").isin("extract", "parse", "load")}),
        constraints.unique(outcomes, "row outcome key", ID),
        constraints.unique(sheets, "sheet key", ["book", "sheet_index"]),
        constraints.foreign_key(outcomes, "outcome to reason", ["reason_code"], reasons, ["code"]),
        constraints.foreign_key(outcomes, "row to sheet", ["book", "sheet_index"], sheets, ["book", "sheet_index"]),
        constraints.foreign_key(outcomes, "kept row to row", ["kept_book", "kept_sheet_index", "kept_row_num"], outcomes, ID),
    ]


def run_load(spark: SparkSession, books_dir: str, out_dir: str) -> LoadResult:
    """Loads a folder of workbooks over what ``out_dir`` holds; the same books again change nothing."""
    started = dt.datetime.now(dt.UTC)
    before, run_id = upsert.snapshot(spark, out_dir), uuid.uuid4().hex
    tables = build_from(read_grids(spark, books_dir), {name: before.read(name) for name in TABLES if name in before})
    workbooks, rows_in = tables["sheets"].select("book").distinct().count(), tables["row_outcomes"].count()
    if not workbooks:
        raise FileNotFoundError(f"no workbooks in {books_dir}")
    staged = {name: upsert.stage(before, run_id, name, tables[name], key, values, IDS.get(name)) for name, (key, values) in TABLES.items()}
    checked = {name: s.full for name, s in staged.items()} | {k: v for k, v in tables.items() if k not in TABLES}
    broken = violations(checked).collect()  # of what would be published; a row per broken rule
    if broken:
        raise ValueError(f"constraints broken: {[(r['rule'], r['violations']) for r in broken]}")
    upsert.publish(before, run_id, staged, {k: v for k, v in tables.items() if k not in TABLES})
    counts = {name: (s.inserted, s.updated) for name, s in staged.items()}
    log = [(run_id, started, dt.datetime.now(dt.UTC), workbooks, rows_in, {k: {"inserted": a, "updated": b} for k, (a, b) in counts.items()})]
    runs = spark.createDataFrame(log, "run_id string, started_at timestamp, finished_at timestamp, workbooks int, rows_in int, changes map<string,map<string,long>>")
    runs.write.mode("append").parquet(f"{out_dir}/load_runs")  # only a run that is in force is logged
    return LoadResult(run_id, workbooks, rows_in, counts)

from datetime import date

import pytest

from tallybook.operators import upsert
from tallybook.plans import load
from tallybook.sources.layout import classify_rows, find_layouts
from tallybook.sources.workbook import read_grids, write_book


@pytest.fixture(scope="module")
def books(tmp_path_factory):
    d = tmp_path_factory.mktemp("books")
    two_level = [
        ["What we bought in 2019"] + [None] * 6,
        ["Order", None, "Supplier", "Item", None, "Amount (Frw)", None],
        ["Date", "Number", None, "Code", "Qty", "Value", "Currency"],
        [date(2019, 1, 4), "PO-2019-00001", "Harrow Cloth Mills", "FAB-COT-001", 10, 5000, "RWF"],
        [None] * 7,
        ["Total of January", None, None, None, None, 5000, None],
        ["Date", "Number", "Supplier", "Code", "Qty", "Value", "Currency"],
        ["05/02/2019", "PO-2019-00002", "Total Crates Ltd", "PKG-BAG-001", 5, "2,500/=", None],
        ["25/03/2019", "PO-2019-00003", "HARROW CLOTH MILLS LTD", "FAB-COT-001", 2, "TBC", None],
        [date(2019, 1, 4), "po 2019/1", "Harrow Cloth Mills", "FAB COT 1", 10, 5000, None],
        [date(2019, 1, 4), "po 2019/1", "Harrow Cloth Mills", "FAB COT 1", 11, 5000, None],
    ]
    (d / "purchases_2019.xlsx").write_bytes(write_book([("Q1", two_level, ["A1:G1", "A2:B2", "C2:C3", "D2:E2", "F2:G2"]), ("Notes", [["text only"]], [])]))
    (d / "item_master.xlsx").write_bytes(write_book([("Items", [["Code", "Description", "Category", "Unit"], ["FAB-COT-001", "Cotton", "Fabric", "m"], ["PKG-BAG-001", "Bag", "Packaging", "pcs"]], [])]))
    pay = [["Emp No", "Name", "Gross", "Deductions", "Net"], ["E014", "Ann Smith", 100, 10, 90], [None, "SMITH, Ann", 100, 10, 90], ["E015", "Bo", 100, 10, 80]]
    (d / "payroll_2019.xlsx").write_bytes(write_book([("Jan 2019", pay, []), ("Feb 2019", [pay[0], pay[2]], [])]))
    stock = [["Date", "Voucher No", "Code", "Movement", "Qty In", "Qty Out", "Ref"], [date(2019, 1, 9), "GRN-2019-1", "FAB-COT-001", "GRN", "10 m", None, "PO-2019-00001"], [date(2019, 1, 10), "ISS-2019-1", "FAB-COT-001", "issue", None, 4, None]]
    (d / "inventory_2019.xlsx").write_bytes(write_book([("Stock", stock, [])]))
    sold = [["Date", "Receipt No", "Channel", "Description", "Qty", "Amount (USD)"], [date(2019, 3, 5), "RCT-2019-1", "shop", "cotton", 2, 30], [date(2019, 3, 5), "RCT-2019-2", "moon", "cotton", 2, 30]]
    (d / "sales_2019.xlsx").write_bytes(write_book([("Sales", sold, [])]))
    return str(d)


def test_layout_and_kinds(spark, books):
    grids = read_grids(spark, books)
    layouts = {(r["book"], r["sheet_index"]): r for r in find_layouts(grids).collect()}
    q1 = layouts["purchases_2019.xlsx", 0]
    assert q1["header_row"] == 3 and {e["field"] for e in q1["entries"]} == {"date", "po_number", "supplier", "sku", "quantity", "amount", "currency"}
    assert q1["hints"] == {"amount": "RWF", "currency": "RWF"}
    assert layouts["purchases_2019.xlsx", 1]["skipped_reason"] == "no recognisable header"
    rows = classify_rows(grids, find_layouts(grids)).where("book = 'purchases_2019.xlsx'").orderBy("row_num").collect()
    assert [r["kind"] for r in rows] == ["data", "blank", "subtotal", "repeated_header", "data", "data", "data", "data"]


def test_intake_takes_each_book_once(spark, books, tmp_path):
    from tallybook.sources.workbook import SCHEMA
    from tallybook.streaming.intake import stage_new_books

    for _ in range(2):
        stage_new_books(spark, books, str(tmp_path / "grids"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(str(tmp_path / "grids")).count() == read_grids(spark, books).count()


@pytest.fixture(scope="module")
def loaded(spark, books, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "tables")
    return out, load.run_load(spark, books, out)


def test_load(spark, books, loaded):
    out, first = loaded
    got = {(r["book"], r["sheet_index"], r["row_num"]): (r["outcome"], r["reason_code"]) for r in upsert.current(spark, out, "row_outcomes").collect()}
    assert len(got) == first.rows_in
    p = {n: got["purchases_2019.xlsx", 0, n] for n in range(4, 12)}
    assert p == {
        4: ("loaded", None), 5: ("skipped", "BLANK_ROW"), 6: ("skipped", "SUBTOTAL_ROW"), 7: ("skipped", "REPEATED_HEADER"), 8: ("loaded", None), 9: ("rejected", "BAD_AMOUNT"),
        10: ("merged", None), 11: ("rejected", "CONFLICTING_DUPLICATE"),
    }
    assert got["payroll_2019.xlsx", 0, 3] == ("merged", None) and got["payroll_2019.xlsx", 0, 4] == ("rejected", "NET_MISMATCH")
    assert got["sales_2019.xlsx", 0, 3] == ("rejected", "UNKNOWN_CHANNEL")
    sale = upsert.current(spark, out, "sales").first()
    assert str(sale["amount_rwf"]) == "37500.00" and sale["sku"] == "FAB-COT-001"  # 30 USD at 1000 + 5 * 50
    moves = {r["voucher_no"]: (float(r["quantity"]), r["po_number"]) for r in upsert.current(spark, out, "movements").collect()}
    assert moves == {"GRN-2019-00001": (10.0, "PO-2019-00001"), "ISS-2019-00001": (-4.0, None)}
    ids = lambda: {t: {r[c] for r in upsert.current(spark, out, t).select(c).collect()} for t, c in load.IDS.items()}
    before = ids()
    assert before["products"] == {1, 2} and all(found == set(range(1, len(found) + 1)) for found in before.values())
    again = load.run_load(spark, books, out)
    assert set(again.changes.values()) == {(0, 0)} and ids() == before
    now = upsert.snapshot(spark, out)
    assert now.number == 2 and all(f"run={first.run_id}" in p for t in load.TABLES for p in now.paths[t].values())  # nothing was written anew


def test_report(spark, loaded, tmp_path):
    from tallybook.plans import reports

    out, _ = loaded
    pages = []
    for i in range(2):
        numbers = reports.build_report(spark, out, str(tmp_path / f"{i}.html"), str(tmp_path / f"{i}.json"))
        pages.append((tmp_path / f"{i}.html").read_text() + (tmp_path / f"{i}.json").read_text())
    assert pages[0] == pages[1] and numbers["core_products"] == 2 and numbers["rows_skipped"] == 3
    t = {n: upsert.current(spark, out, n) for n in ("products", "po_lines", "sales", "movements", "payroll_lines", "row_outcomes")}
    assert all(r["missing"] == 0 for r in reports.by_book(t["row_outcomes"], reports.loaded_rows(t)).collect())


def test_generated_books_are_scored(spark, tmp_path):
    """Generate, load, score: outcomes agree with the truth, and so do dates, amounts and currencies; no suppliers are merged wrongly."""
    from tallybook.plans import reports, synthetic

    synthetic.generate(str(tmp_path), 42, 2018, 2018, 25)
    load.run_load(spark, str(tmp_path / "books"), str(tmp_path / "tables"))
    n = reports.build_report(spark, str(tmp_path / "tables"), str(tmp_path / "r.html"), str(tmp_path / "r.json"), str(tmp_path / "truth"))
    assert n["outcomes_checked"] > 400 and n["outcomes_right"] / n["outcomes_checked"] > 0.995
    assert n["dates_right"] == n["dates_checked"] > 100 and n["amounts_right"] == n["amounts_checked"] > 50 and n["currencies_right"] == n["currencies_checked"] > 50
    assert n["false_merges"] == 0 and n["suppliers_true"] > 0 and n["review_right"] <= n["review_queue"] and n["loaded_rows_missing"] == 0
    assert (n["seed"], n["years"], n["load_runs"], n["last_run_updated"]) == (42, "2018-2018", 1, 0) and n["sheets_read"] > n["sheets_skipped"] > 0
    text = tmp_path / "notes.md"
    text.write_text("\n".join(reports.BLOCK))
    assert reports.update_text(str(text), n) and f"| Suppliers in truth | {n['suppliers_true']} |" in text.read_text()
    details = upsert.current(spark, str(tmp_path / "tables"), "row_outcomes").where("outcome = 'rejected'")
    assert details.where("detail IS NULL").count() == 0


def test_later_load_knows_what_is_published(spark, books, loaded, tmp_path):
    """Only sales and stock in the second load: their products and orders are those of the first. A load that is cut short changes nothing."""
    import shutil

    out, _ = loaded
    mine = str(tmp_path / "tables")
    shutil.copytree(out, mine)
    (tmp_path / "books").mkdir()
    for name in ("sales_2019.xlsx", "inventory_2019.xlsx"):
        shutil.copy(f"{books}/{name}", tmp_path / "books" / name)
    (tmp_path / "books" / "stray.xlsx").write_bytes(b"no workbook at all")
    before = {t: upsert.current(spark, mine, t).count() for t in load.TABLES}
    second = load.run_load(spark, str(tmp_path / "books"), mine)
    assert all(changed == (0, 0) for t, changed in second.changes.items() if t != "fx_rates")
    assert {t: upsert.current(spark, mine, t).count() for t in load.TABLES if t != "fx_rates"} == {t: n for t, n in before.items() if t != "fx_rates"}
    outcomes = upsert.current(spark, mine, "row_outcomes")
    assert outcomes.where("reason_code = 'UNKNOWN_PRODUCT'").count() == 0
    assert {r["po_number"] for r in upsert.current(spark, mine, "movements").collect()} == {"PO-2019-00001", None}
    assert upsert.current(spark, mine, "sheets").where("book = 'stray.xlsx'").first()["skipped_reason"] == "file name does not identify a domain"
    number, run_id = upsert.pointer(spark, mine)
    spark.range(1).write.parquet(f"{mine}/run=half/products")  # written, but never switched to
    assert upsert.pointer(spark, mine) == (number, run_id) and upsert.pointer(spark, str(tmp_path / "none")) is None

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.functions import dates, money, text


def test_codes(evaluate):
    assert evaluate(text.sku, ["FAB COT 001", "fab-cot-001", "FABCOT001", "FAB-COT-1", "FAB", None]) == ["FAB-COT-001"] * 4 + [None] * 2
    assert evaluate(lambda c: text.document(c, "purchases"), ["po 2019/42", "PO2019-00042", "RCT-2019-1", ""]) == ["PO-2019-00042"] * 2 + [None] * 2
    assert evaluate(text.employee, ["EMP-014", "e14", "14", "E1234", "x"]) == ["E014", "E014", "E014", "E1234", None]
    assert evaluate(text.name_key, ["SMITH John", "Smith, John", "Jöhn  smith", ""]) == ["john smith"] * 3 + [""]
    assert evaluate(text.description_key, ["Cotton (Blue) 2m", "--", None]) == ["cotton blue 2m", None, None]
    assert evaluate(text.channel, ["W/Sale", " Shop", "x"]) == ["wholesale", "showroom", None]
    assert evaluate(text.movement_type, ["Goods  Received", "ADJ", None]) == ["receipt", "adjustment", None]
    assert evaluate(text.clean, ["a  b ", None]) == ["a b", ""]


MONEY = {
    "125000": ("125000", None), "1250.5": ("1250.5", None), "125,000": ("125000", None), "125 000": ("125000", None), "125 000": ("125000", None),
    "125,000/=": ("125000", None), "125,000/-": ("125000", None), "RWF 125,000": ("125000", "RWF"), "125,000 Frw": ("125000", "RWF"),
    "$1,250.50": ("1250.50", "USD"), "1.250.000": ("1250000", None), "1.250,50": ("1250.50", None), "12,5": ("12.5", None), "(1,250)": ("-1250", None), "-80": ("-80", None),
}


def test_money(evaluate):
    got = evaluate(money.money, list(MONEY))
    assert [(g["amount"], g["currency"], g["reason"]) for g in got] == [(Decimal(a), c, None) for a, c in MONEY.values()]
    bad = evaluate(money.money, ["TBC", "n/a", "#VALUE!", "see invoice", "12,34,56", "1.2.3", "", None, "$ 5 Frw"])
    assert [b["reason"] for b in bad] == ["BAD_AMOUNT"] * 6 + ["MISSING_FIELD"] * 2 + ["CURRENCY_CONFLICT"]


def test_quantity(evaluate):
    got = evaluate(money.quantity, ["85", "170.5", "120 m", "1,100 pcs", "50 pc", "-85", "3 rolls", "x", " "])
    assert [g["quantity"] for g in got] == [Decimal(x) for x in ("85", "170.5", "120", "1100", "50", "-85", "3")] + [None] * 2
    assert [g["reason"] for g in got[-2:]] == ["BAD_QUANTITY", "MISSING_FIELD"]


def test_currency_precedence(spark):
    rows = [("usd", None, None, "RWF"), (None, "RWF", None, "USD"), ("", None, None, "RWF"), (None, None, None, None), ("usd", "RWF", None, None), (None, "USD", "RWF", None), ("yen", None, None, None)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, a string, p string, h string")
    got = [r["r"] for r in d.select("i", money.resolve_currency(F.col("c"), F.col("a"), F.col("p"), F.col("h")).alias("r")).orderBy("i").collect()]
    assert [(r["currency"], r["source"], r["reason"]) for r in got] == [
        ("USD", "column", None), ("RWF", "embedded", None), ("RWF", "header", None), (None, None, "UNKNOWN_CURRENCY"),
        (None, None, "CURRENCY_CONFLICT"), (None, None, "CURRENCY_CONFLICT"), (None, None, "UNKNOWN_CURRENCY"),
    ]


def test_date_tokens(evaluate):
    clear = ["43529", "2019-03-05", "2019/3/5", "5 Mar 2019", "05-Mar-19", "March 5, 2019", "5-MARCH-2019"]
    assert [t["value"] for t in evaluate(dates.tokenize, clear)] == [date(2019, 3, 5)] * 7
    more = evaluate(dates.tokenize, ["25/03/2019", "03/25/2019", "25.03.2019", "25/03/19", "07/07/2019"])
    assert [(t["value"], t["method"]) for t in more] == [(date(2019, 3, 25), m) for m in ("day_first", "month_first", "day_first", "day_first")] + [(date(2019, 7, 7), "same_day_month")]
    bad = evaluate(dates.tokenize, ["31/02/2019", "2019-13-04", "??/03/2019", "32/13/2019", "12", "next week"])
    assert {t["method"] for t in bad} == {"invalid"}


@pytest.mark.parametrize(
    ("cells", "expected"),
    [
        (["28/08/2019", "09/14/2019", "09/10/2019", "09/20/2019", "02/10/2019", "25/10/2019"], {2: ("2019-09-10", "neighbours"), 4: ("2019-10-02", "neighbours")}),
        (["25/03/2019", "04/05/2019"], {1: ("2019-05-04", "sheet_convention")}),
        (["25/03/2019", "03/25/2019", "04/05/2019"], {2: (None, "ambiguous")}),
    ],
)
def test_date_column(spark, cells, expected):
    d = spark.createDataFrame([("b", "s", i, c) for i, c in enumerate(cells)], "book string, sheet string, row_num int, cell string")
    low, high = dates.valid_range(F.lit(2019))
    got = dates.resolve_dates(d.select("*", dates.tokenize(F.col("cell")).alias("t"), low.alias("range_start"), high.alias("range_end")), "t").orderBy("row_num").collect()
    for i, (value, method) in expected.items():
        assert (str(got[i]["date"]) if got[i]["date"] else None, got[i]["date_method"]) == (value, method)


def test_period(evaluate):
    names = ["Jan 2019", "JAN-19", "2019-01", "01.2019", "Jan19", "January", "Sept", "Dec 2018 (2)", "Summary", "Marketing"]
    got = evaluate(lambda c: dates.parse_period(c, F.lit(2019)), names)
    assert got == [date(2019, 1, 1)] * 6 + [date(2019, 9, 1), date(2018, 12, 1), None, None]
    assert evaluate(lambda c: dates.parse_period(c, F.lit(None).cast("int")), ["January"]) == [None]


def test_implied_price_and_small_numbers(spark):
    from tallybook.sources.workbook import number_text

    rows = spark.createDataFrame([("100", "0.333"), ("100", "0.004"), ("1", "0"), ("10", "3"), ("0.00005", "1"), ("0.00015", "1")], "a string, q string")
    got = [str(r[0]) for r in rows.select(money.implied_price(F.col("a").cast(money.DECIMAL), F.col("q").cast(money.DECIMAL))).collect()]
    assert got == ["300.3003", "25000.0000", "None", "3.3333", "0.0000", "0.0002"]
    assert [number_text(x) for x in (0.00001, 5.0, 1e20, 0.1, -2.5)] == ["0.00001", "5", "100000000000000000000", "0.1", "-2.5"]


def test_repeated_descriptions_and_names(spark):
    from tallybook.operators import resolve

    items = spark.createDataFrame([("A", "cotton"), ("B", "cotton"), ("C", "silk")], "code string, key string").withColumn("id", F.col("code"))
    rows = spark.createDataFrame([(1, None, "cotton"), (2, None, "silk"), (3, "A", None), (4, "Z", None)], "n int, c string, d string")
    assert [(r["n"], r["id"]) for r in resolve.by_code_or_key(rows, items, "c", "d", "id", "code", "key").orderBy("n").collect()] == [(1, None), (2, "C"), (3, "A"), (4, None)]

"""How parsers and matching are planned: compiled projections, costly functions once a name or pair."""

import sys
import unicodedata
from decimal import Decimal

from pyspark.sql import functions as F

import tallybook.ledger_registry  # noqa: F401  (fills the queries)
from tallybook.functions import money, text
from tallybook.operators import matching
from tallybook.plans import rows as parse
from tallybook.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folding_is_that_of_the_unicode_tables(evaluate):
    fold = lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    points = [c for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and (fold(c := chr(i)) or unicodedata.name(c, "").startswith("LATIN"))]
    lines = ["x" + "-".join(points[i : i + 50]) for i in range(0, len(points), 50)] + ["", "Żółć ŁÓDŹ", "ßæ", "é", "a\U0001f600b", "ﬃ Ⅸ"]
    assert evaluate(text.ascii_fold, lines) == [fold(x) for x in lines]


def test_parsers_are_compiled(spark):
    """No lambda but the map of rare characters in names, and no Python, in the plans of the row parsers."""
    for name in ("parse_sales", "parse_movements", "first_reason", "parse_products", "parse_payroll"):
        shown = plan(QUERIES[name](spark, SF))
        assert "ArrowEvalPython" not in shown and "BatchEvalPython" not in shown
        if name in ("parse_sales", "parse_movements", "first_reason"):
            assert "lambda" not in shown


def test_parsers_copy_rows_seldom(spark):
    """Few projections, and no pattern is replaced where a look at the text shows that it stands nowhere."""
    for name, most in (("parse_sales", 13), ("parse_movements", 12), ("first_reason", 11)):
        shown = plan(QUERIES[name](spark, SF)).split("== Initial Plan ==")[0]
        projections = [line for line in shown.split("\n") if "Project [" in line]
        assert len(projections) <= most, (name, len(projections))
        assert not [p for p in projections if "AS __let" in p and p.count("(?U)") > p.count("RLIKE")]


def test_short_cuts_of_stages_change_nothing(spark):
    """On a stage, neat texts take a shorter way than in a lone expression, with the same results."""
    odd = ["", " ", "5", " 5", "5\n", "5\u00a0", "a b", "a  b", "a\u3000b", "\x85x", "Frw 1,250/=", "Frw\u00a01,250 /-", "/=", "5/=/=", "5/= ", "us$5", "5 USD", "USD 5 Frw", "$(1.250,50)", "- 5", "(-5)", "(- 5 )", "1 000", "1\u00a0000.5"]
    odd += ["1,2,3", "1,000,00.5", "1.000,5", "1..2", "12 pcs", "12 pcs.", "12 PCS ", "pcs", "m", "5.", "\u0663", "1,250 m\u00a0", "fab cot 1", "FAB-COT-0001", "fab_cot.12", "f\u00e9b cot 1", "po 2019/42", "PO\u20132019 - 00042", "PO_2019_42", "po201942", "PO 2019 4200000"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([*odd, None])], "i int, x string")
    parsers = {"money": money.money, "quantity": money.quantity, "sku": text.sku, "po": lambda c: text.document(c, "purchases"), "channel": text.channel, "currency": money.currency, "clean": text.clean, "trimmed": text.trimmed}
    on_stage = text.staged(rows, **{k: (lambda f=f: f(F.col("x"))) for k, f in parsers.items()})
    lone = rows.select("i", *[f(F.col("x")).alias(k) for k, f in parsers.items()])
    assert on_stage.select("i", *parsers).orderBy("i").collect() == lone.orderBy("i").collect()
    found = {x: y["money"] for x, y in zip(odd, on_stage.orderBy("i").collect(), strict=False)}
    assert [found[x]["reason"] for x in ("", "5/=/=", "USD 5 Frw")] == ["MISSING_FIELD", "BAD_AMOUNT", "CURRENCY_CONFLICT"]
    assert (found["Frw 1,250/="]["amount"], found["Frw\u00a01,250 /-"]["currency"], found["$(1.250,50)"]["amount"]) == (1250, "RWF", Decimal("-1250.5"))


def test_stages_bind_by_level(spark):
    rows = spark.createDataFrame([("fab cot 1", "po 2019/42")], "a string, b string")
    out = text.staged(rows, code=lambda: text.sku(F.col("a")), number=lambda: text.document(F.col("b"), "purchases"), a=lambda: F.upper("a"))
    assert out.first().asDict() == {"b": "po 2019/42", "code": "FAB-COT-001", "number": "PO-2019-00042", "a": "FAB COT 1"}
    with parse.Cells(rows) as stage:
        x = stage.bind(F.col("a"))
        y = stage.bind(F.col("b"))
        z = stage.bind(F.concat(x, y))
    assert [sorted(level) for level in stage._levels] == [["__let0", "__let1"], ["__let2"]] and stage.rows().select(z).first()[0] == "fab cot 1po 2019/42"


def test_each_pair_is_scored_once_after_the_exchange(spark):
    keys = spark.createDataFrame([("alpha textiles", "alpha"), ("alpa textiles", "alpa"), ("beta mills", "beta")], "match_key string, identity string")
    pairs = matching.candidate_pairs(keys)
    shown = plan(pairs).split("== Initial Plan ==")[0]
    assert shown.count("ArrowEvalPython") == 1
    assert "Join" not in shown[: shown.index("Exchange")] and "ArrowEvalPython" in shown[: shown.index("Exchange")]
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [("alpa textiles", "alpha textiles")]


def test_names_are_keyed_once_a_spelling(spark):
    """The rules run on distinct spellings, whatever groups or distincts are put on top."""
    counts = spark.range(5000).select(F.concat(F.lit("Shop "), (F.col("id") % 7).cast("string")).alias("alias")).groupBy("alias").agg(F.count("*").alias("n"))
    shown = plan(counts.select(matching.keys_of("alias").alias("k")).select("k.match_key").distinct())
    assert shown.index("ArrowEvalPython") < shown.rindex("HashAggregate(keys=[alias")  # plans are shown from the top


def test_every_rule_of_the_targets_fires(spark):
    """The query's tables break each rule; tables that keep all of them break none."""
    from tallybook import ledger_registry as ledger

    rules = {name for table in ledger._RULES.values() for name in table} | {f"{t} key" for t in ledger._KEYS} | {r[0] for r in ledger._REFERENCES} | {"products description"}
    found = {r["rule"]: r["violations"] for r in QUERIES["target_constraints"](spark, "/root/testdata/sf0.01").collect()}
    assert set(found) == rules and min(found.values()) > 0


def test_rules_of_the_targets_read_their_columns(spark):
    """The wide tables aren't written whole before the rules are looked at; only those with a row a month are."""
    shown = plan(QUERIES["target_constraints"](spark, SF)).split("== Initial Plan ==")[0]
    written = {part.split("#")[0] for part in shown.split("ExistingRDD[")[1:]}
    assert written <= {"currency", "month", "rate_to_rwf", "period", "employee_count"} and "FileScan parquet" in shown


def test_rows_are_counted_by_key_before_they_are_looked_up(spark):
    from tallybook.operators import constraints

    rows = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)] * 4 + [("a", 2), (None, 1), ("b", None)], "k string, m int")
    parent = spark.createDataFrame([("a", 1), ("a", 1), ("c", 2)], "k string, m int")
    found = constraints.foreign_key(rows, "rule", ["k", "m"], parent, ["k", "m"])
    shown = plan(found).split("== Initial Plan ==")[0]
    assert "HashAggregate(keys=[k" in shown[shown.index("LeftAnti") :] and found.first().asDict() == {"rule": "rule", "violations": 5}
    assert constraints.foreign_key(rows.where("k = 'c'"), "rule", ["k", "m"], parent, ["k", "m"]).first()["violations"] == 0


def test_parsed_rows_that_no_source_row_has(spark):
    from tallybook.operators import constraints

    rows = spark.createDataFrame([("b", 0, 1), ("b", 0, 2)], "book string, sheet_index int, row_num int")
    parsed = spark.createDataFrame([("b", 0, 2), ("b", 0, 3), ("c", 0, 1)], "book string, sheet_index int, row_num int")
    assert constraints.foreign_key(parsed, "parsed row to row", parse.ID, rows, parse.ID).first()["violations"] == 2


def test_lines_are_sorted_once_for_row_kinds(spark):
    """Headers are looked for in the first rows of a sheet, and a row's key goes with it: all lines are numbered in one window, and never joined to themselves."""
    shown = plan(QUERIES["row_kinds"](spark, SF)).split("== Initial Plan ==")[0]
    windows = [line for line in shown.split("\n") if " Window [" in line and "row_number() windowspecdefinition(l_suppkey" in line]
    assert windows and len(windows) - shown.count("Final") <= 1, (len(windows), shown.count("Final"))

"""Merging and running balances with one key for a third of the rows or more."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.operators import dedupe
from tallybook.plans import stock


def test_copies_of_a_hot_key(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(900)}", rng.choice("ab"), i) for i in range(6000)]
    rng.shuffle(rows)
    given = spark.createDataFrame(rows, "k string, print string, n int")
    seen, expected = {}, []
    for k, p, n in sorted(rows, key=lambda r: r[2]):
        first, count = seen.get(k, ((p, n), 0))
        seen[k] = (first, count + 1)
        expected.append((k, n, count + 1, "loaded" if not count else "merged" if p == first[0] else "rejected", first[1]))
    ranked = dedupe.rank_copies(given, ["k"], ["n"], "print", ["n"])
    got = ranked.select("k", "n", "copy_no", dedupe.outcome().alias("o"), "kept_n").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    firsts = dedupe.first_copies(given, ["k"], ["n"], "print", ["n"])
    got = firsts.select("k", "n", dedupe.outcome(first=F.col("is_first")).alias("o"), "kept_n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(k, n, o, f) for k, n, _, o, f in expected], key=str)


def test_balance_of_a_hot_item(spark):
    rng = random.Random(6)
    rows = [("hot" if i % 3 else f"p{i % 20}", date(2015, 1, 1) + timedelta(rng.randrange(2000)), Decimal(rng.randrange(-9, 10))) for i in range(5000)]
    found = stock.negative_stock(spark.createDataFrame(rows, "item string, day date, quantity decimal(18,2)"))
    days = defaultdict(lambda: defaultdict(Decimal))
    for item, day, q in rows:
        days[item][day] += q
    expected = []
    for item, net in days.items():
        total, below = Decimal(0), []
        for day in sorted(net):
            total += net[day]
            if total < 0:
                below.append((day, total))
        if below:
            expected.append((item, *below[0], len(below)))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_windows_never_hold_a_whole_item(spark):
    rows = spark.createDataFrame([("a", date(2019, 1, 1), Decimal(1))], "item string, day date, quantity decimal(18,2)")
    shown = stock.negative_stock(rows)._jdf.queryExecution().analyzed().toString()
    windows = [line for line in shown.split("\n") if "windowspecdefinition" in line]
    assert len(windows) >= 2 and all("__month" in w or "__m#" in w for w in windows)


def test_a_name_pair_costs_no_candidates_of_its_length(spark):
    """Short names are joined on what they must have in common: of many names of one length and one alphabet hardly any other pair is looked at."""
    from itertools import combinations

    from tallybook.operators import matching

    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice((8, 9)))) for _ in range(500)} | {"abcdefghi", "abcdfghi"})
    keys = spark.createDataFrame([(f"{w} textiles", w) for w in words], "match_key string, identity string")
    looked_at = matching._by_subsequence(keys, [8, 9], 73).distinct().collect()
    want = {(f"{a} textiles", f"{b} textiles") for a, b in combinations(words, 2) if matching.similarity(f"{a} textiles", f"{b} textiles", a, b) >= 73}
    assert {(r["a"], r["b"]) for r in looked_at} == want == {(r["a"], r["b"]) for r in matching.candidate_pairs(keys).collect()} and ("abcdefghi textiles", "abcdfghi textiles") in want


def test_only_merging_edges_make_rounds(spark, monkeypatch):
    """A chain of names that are only alike enough for review is decided without a round a link."""
    from tallybook.operators import matching

    made = []
    monkeypatch.setattr(matching, "settled", lambda df: made.append(1) or df.localCheckpoint())
    keys = [(f"k{i:02d}", 100 - i) for i in range(40)]
    edges = [(f"k{i:02d}", f"k{i + 1:02d}", 90.0 if i == 5 else 75.0) for i in range(39)]
    got = matching.greedy_rounds(spark.createDataFrame(keys, "match_key string, n long"), spark.createDataFrame(edges, "a string, b string, score double")).collect()
    found, queue = matching.greedy(keys, edges)
    assert {r["key"]: (r["anchor"], r["score"]) for r in got} == found and {r["key"]: (r["nearest"], r["nearest_score"]) for r in got if r["nearest"]} == queue
    assert len(made) < 8


def test_rows_without_a_value_are_no_task_of_their_own(spark):
    from tallybook.operators import resolve

    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.lit("o"), (F.col("id") % 100).cast("string"))).alias("o"))
        known = spark.createDataFrame([("o0",), ("o0",), ("o40",), (None,)], "o string")
        out = resolve.if_known(rows, "o", known)
        got = out.withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.columns == ["id", "o"] and {r["id"]: r["o"] for r in got} == {i: f"o{i % 100}" if i % 100 in (0, 40) else None for i in range(4000)} and len(got) == 4000
    assert max(sum(r["p"] == p for r in got if r["id"] % 4) for p in range(4)) < 1000  # of 3,000 without a value


def test_copies_go_through_one_shuffle(spark):
    """No ranges, no rows joined back, unless a key is hot; a hot key's rows are sorted apart and get the same numbers."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(900)}", rng.choice("ab"), i) for i in range(6000)]
    given = spark.createDataFrame(rows, "k string, print string, n int")
    plain, split = (dedupe.rank_copies(given, ["k"], ["n"], "print", ["n"], most) for most in (1_000_000, 1000))
    assert {r["k"] for r in dedupe.hot_keys(given, ["k"], 1000)} == {"hot", None} and dedupe.hot_keys(given, ["k"], 1_000_000) == []
    shown = plain._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert shown.count("Exchange") == 1 and "Join" not in shown
    columns = ["k", "n", "print", "copy_no", "kept_print", "kept_n"]
    assert sorted(plain.select(columns).collect(), key=str) == sorted(split.select(columns).collect(), key=str)

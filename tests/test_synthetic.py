import random
from itertools import combinations

from tallybook.operators import matching
from tallybook.plans import synthetic


def test_generator_is_deterministic(tmp_path):
    a, b = (synthetic.generate(str(tmp_path / x), 7, 2018, 2018, 20) for x in "ab")
    assert a == b and a["expected"]["rejected"] + a["expected"]["merged"] > 0
    assert (tmp_path / "a/truth/rows.csv").read_text() == (tmp_path / "b/truth/rows.csv").read_text()
    assert (tmp_path / "a/books/sales_2018.xlsx").read_bytes() == (tmp_path / "b/books/sales_2018.xlsx").read_bytes()


def test_names():
    same = ["Fowler & Sons Textiles Ltd", "FOWLER AND SONS TEXTILES", "Fowler Sons Tex. S.A.R.L", "Fowler  & Sons Textiles Co. Ltd.", "FOWLER SONS TEXTILES PLC"]
    assert {matching.supplier_key(s) for s in same} == {"fowler sons textiles"}
    assert matching.supplier_key("Johnsontextiles") == "johnson textiles" and matching.supplier_key("Henderson House") == "henderson house"
    assert matching.identity("henderson house") == "henderson" and matching.identity("textiles") == "textiles"
    assert matching.ratio("abcd", "abcd") == 100 and matching.ratio("ab", "cd") == 0 and matching.common_length("kitten", "sitting") == 4


def test_greedy_and_review():
    found, queue = matching.greedy([("doyle cloth", 9), ("doyla cloth", 3), ("x", 1)], [("doyla cloth", "doyle cloth", 80.0)])
    assert found["doyla cloth"][0] == "doyla cloth" and queue == {"doyla cloth": ("doyle cloth", 80.0)}
    found, queue = matching.greedy([("b", 5), ("a", 5), ("c", 1)], [("a", "c", 90.0), ("b", "c", 90.0)])
    assert found["c"] == ("a", 90.0) and not queue


def test_match_suppliers(spark):
    rows = [("Henderson Textiles", 9), ("HENDERSON TEXTILES LTD", 2), ("Hendreson Textiles", 1), ("Walker Packaging", 5), ("Ltd", 1)]
    got = {r["alias"]: r for r in matching.match_suppliers(spark.createDataFrame(rows, "alias string, row_count long")).collect()}
    assert [got[a]["method"] for a, _ in rows[:4]] == ["exact", "normalized", "fuzzy", "exact"]
    assert len({got[a]["anchor"] for a, _ in rows[:3]}) == 1 and got["Ltd"]["canonical"] == "Ltd"
    truth = spark.createDataFrame([("a", 1, "X"), ("b", 1, "X"), ("c", 1, "Y"), ("d", 2, "Y")], "n string, p int, t string")
    r = matching.pair_scores(truth, "p", "t").first()
    assert (r["true_pairs"], r["predicted"], r["correct"]) == (2, 3, 1)


def test_candidates_are_all_pairs(spark):
    """supplier_match: against a comparison of all names, of which some differ at both ends of their identifying words."""
    rng = random.Random(5)
    names = ["Hendersen Textiles", "Benderson Textiles", "Xaviersonmanni", "Yaviersonmannu", "Ltd", "Limited", "Co", "Rose Cloth Merchants"]
    for _ in range(60):
        word = "".join(rng.choice("aeionrst") for _ in range(rng.randint(3, 12)))
        second = "".join(rng.choice("lmnaeo") for _ in range(rng.randint(2, 5)))
        names += [f"{word} {second} Textiles", f"{second} {rng.choice('bdk')}{word[1:-1]}{rng.choice('xyz')} Fabrics", f"{word[1:]}"]
    counts = spark.createDataFrame([(n, 1) for n in sorted(set(names))], "alias string, row_count long")
    keys = counts.select(matching.keys_of("alias").alias("k"), "alias").selectExpr("coalesce(nullif(k.match_key, ''), lower(alias)) AS match_key", "k.identity").distinct()
    want = {(a, b): round(s, 9) for a, b in combinations(sorted(r["match_key"] for r in keys.collect()), 2) if (s := matching.similarity(a, b)) >= 73}
    got = [((r["a"], r["b"]), round(r["score"], 9)) for r in matching.candidate_pairs(keys).collect()]
    assert dict(got) == want and len(got) == len(want) and ("benderson textiles", "hendersen textiles") in want
    queued = {r["alias"]: r["nearest"] for r in matching.match_suppliers(counts.where("alias LIKE '%enders%'")).collect()}
    assert queued == {"Benderson Textiles": None, "Hendersen Textiles": "benderson textiles"}


def test_candidates_are_not_broadcast(spark):
    """supplier_lines, supplier_match, supplier_pairs: once the few bytes of the keys are known, the many rows made of them still aren't sent to the driver."""
    rng = random.Random(8)
    for length, joined in ((9, "part"), (30, "block")):  # by subsequences, by letters
        names = [("".join(rng.choice("aeionrst") for _ in range(length)),) * 2 for _ in range(30)]
        pairs = matching.candidate_pairs(spark.createDataFrame(names, "match_key string, identity string"))
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert f"SortMergeJoin [{joined}#" in plan and f"HashJoin [{joined}#" not in plan


def test_no_names_have_no_pairs(spark):
    """supplier_match: a load without purchases has no supplier names."""
    none = spark.createDataFrame([], "alias string, row_count long")
    assert matching.candidate_pairs(spark.createDataFrame([], "match_key string, identity string")).isEmpty() and matching.match_suppliers(none).isEmpty()


def test_method_follows_the_canonical_spelling(spark):
    """The canonical spelling may have another key than the anchor: what shares its key is normalized, the rest is fuzzy."""
    rows = [("Walker Textiles", 5), ("WALKER TEXTILES LTD", 5), ("Walkers Textiles", 6)]
    got = {r["alias"]: (r["canonical"], r["method"]) for r in matching.match_suppliers(spark.createDataFrame(rows, "alias string, row_count long")).collect()}
    assert got == {"Walkers Textiles": ("Walkers Textiles", "exact"), "Walker Textiles": ("Walkers Textiles", "fuzzy"), "WALKER TEXTILES LTD": ("Walkers Textiles", "fuzzy")}


def test_rounds_are_greedy(spark):
    """The rounds of joins give what the sequential pass gives, on a graph with chains and ties."""
    rng = random.Random(3)
    keys = [(f"k{i:03d}", rng.randint(1, 6)) for i in range(120)]
    edges = [(a, b, rng.choice([75.0, 80.0, 88.0, 90.0, 95.0])) for (a, _), (b, _) in combinations(sorted(keys), 2) if rng.random() < 0.04]
    found, queue = matching.greedy(keys, edges)
    got = matching.greedy_rounds(spark.createDataFrame(keys, "match_key string, n long"), spark.createDataFrame(edges, "a string, b string, score double")).collect()
    assert {r["key"]: (r["anchor"], r["score"]) for r in got} == found and {r["key"]: (r["nearest"], r["nearest_score"]) for r in got if r["nearest"]} == queue

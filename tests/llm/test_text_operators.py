"""License scan, language, near duplicates, lines, substrings: against brute force on small fixtures."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import bagminhash, language_crf, license_scan, line_dedup, suffix_dedup

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a long text, and a column that clashes with results."""
    words = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None, None, None, "x"), (2, "", "en", "a", None), (3, " \n ", None, None, "x"), (None, "null id text with several words in it", "en", "a", "x"), (5, "same words here in both rows. " * 12, "en", "a", "x"), (5, "same words here in both rows. " * 12, "en", "a", "x"), (6, words, "en", None, "x"), (7, "12 34 !!", "en", "b", "x")]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_license_scan(spark, real, odd):
    text = "GNU General Public License, gnu general-public LICENSE! CC BY cc by. Apache  License; MIT\nlicense and mit licensed"
    extra = spark.createDataFrame([(100, text, None, None, None), (101, "xx This work is licensed under the GNU General Public License, version 3. yy", None, None, None), (102, "licensed under the apache", None, None, None)], DOCS)
    got = {r["doc_id"]: r for r in license_scan.spans(extra.unionByName(odd)).collect()}
    assert [r["n_words"] for r in license_scan.spans(odd.where("doc_id = 5")).collect()] == [72, 72]
    kelvin = license_scan.spans(spark.createDataFrame([(1, "wor\u212a M\u0130T mit license")], "doc_id long, text string")).first()
    assert (kelvin["n_words"], kelvin["first_word"], kelvin["n_base"]) == (4, 2, 1)
    a = got[100]
    assert (a["n_words"], a["n_base"], a["first_word"], a["last_word"], a["base_labels"]) == (19, 6, 0, 14, "apache,cc-by,gpl,mit")
    assert set(got[101]["labels"].split(",")) >= {"gpl", "gpl-notice"} and got[101]["score"] == 1.0
    assert got[102]["labels"] == "" and got[102]["score"] < 0.7
    assert got[1]["n_words"] == got[2]["n_words"] == 0 and got[6]["n_words"] == 30000 and None in got
    counted = {r["doc_id"]: r["n_words"] for r in license_scan.spans(real.select("doc_id", "text")).collect()}
    for r in real.collect():
        assert counted[r["doc_id"]] == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate({c: c + 32 for c in range(65, 91)})))
    assert license_scan.spans(empty(spark)).count() == 0


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    e, first = rng.normal(size=(57, 3)), rng.random(57) < 0.1
    first[0] = True
    start, t = rng.normal(size=3), rng.normal(size=(3, 3))
    got = language_crf.forward_backward(e, first, start, t)[0]
    at = [*np.flatnonzero(first), 57]
    for a, b in zip(at[:-1], at[1:], strict=True):
        alpha = [np.exp(start + e[a])]
        for i in range(a + 1, b):
            alpha.append((alpha[-1] @ np.exp(t)) * np.exp(e[i]))
        beta = [np.ones(3)]
        for i in range(b - 1, a, -1):
            beta.insert(0, np.exp(t) @ (np.exp(e[i]) * beta[0]))
        gamma = np.array(alpha) * np.array(beta)
        assert np.allclose(got[a:b], gamma / gamma.sum(axis=1, keepdims=True))


def test_language(spark, odd):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_crf.train(real, 200)
    out = language_crf.tag(real.select("doc_id", "text"), model).join(real.select("doc_id", "lang"), "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()
    assert r["a"] > 0.97
    got = {x["doc_id"]: x for x in language_crf.tag(odd, model, segments=True).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 7)] == ["und"] * 4 and got[1]["score"] == 0
    assert sum(s["n_words"] for s in got[6]["segments"]) == 30000
    junk = ["Привет мир это обычный русский текст о погоде и людях", "Tämä on suomenkielinen teksti joka kertoo säästä ja ihmisistä kaupungissa", "xqzv kkwpt zzrtq bbvnm qwrtp lkjhg fdsqz wrtpq", "これは日本語の文章です"]
    assert all(r["support"] < 0.5 for r in language_crf.tag(spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string"), model).collect())
    assert language_crf.tag(real, model).where("support < 0.5").count() == 0
    same = spark.createDataFrame([(1, f"same id other words {i}", "en") for i in range(300)] + [(1, "same row", "fr")] * 300, "doc_id long, text string, lang string")
    assert language_crf.train(same, 20).langs == ["en", "fr"]
    mixed = spark.createDataFrame([(1, real.where("lang = 'fr'").first()["text"][:400] + " " + real.where("lang = 'de'").first()["text"][:400])], "doc_id long, text string")
    langs = {s["lang"] for s in language_crf.tag(mixed, model, segments=True).first()["segments"] if s["n_words"] > 20}
    assert {"fr", "de"} <= langs
    assert language_crf.identify(empty(spark)).count() == 0
    assert language_crf.train(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {x["lang_pred"] for x in language_crf.tag(odd, None).collect()} == {"und"}


def test_language_without_blanks(spark):
    """One run of letters that changes language in the middle, and a long run in a script with blanks."""
    assert "".join(language_crf.tokens("b" * 100 + " 漢字かな1")) == "b" * 100 + "漢字かな" and max(map(len, language_crf.tokens("b" * 100 + "漢" * 50))) <= 30
    rng = np.random.default_rng(8)
    run = lambda lang, n: "".join(chr(c) for c in rng.integers(*{"zh": (0x4E00, 0x4E60), "ja": (0x3042, 0x3090)}[lang], n))
    docs = [(i, run(lang, 300), lang) for i, lang in enumerate(["zh", "ja"] * 30)]
    model = language_crf.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    mixed = spark.createDataFrame([(1, run("zh", 2000) + run("ja", 2000))], "doc_id long, text string")
    got = language_crf.tag(mixed, model, segments=True).first()["segments"]
    path = np.repeat([s["lang"] for s in got], [s["n_words"] for s in got])
    assert len(path) == 2000 and (path[:1000] == "zh").mean() > 0.98 and (path[1000:] == "ja").mean() > 0.98


def bags_of(texts):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"\w+", (t or "").lower())
        out[i] = Counter(" ".join(w[j : j + 5]) for j in range(max(len(w) - 4, 1))) if w else Counter()
    return out


def test_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 2**63, 300, dtype=np.int64).astype(np.uint64)
    wa, wb = rng.integers(1, 6, 300), rng.integers(1, 6, 300)
    doc = np.repeat([0, 1], 300)
    sig = bagminhash.signatures(doc, np.concatenate([s, s]), np.concatenate([wa, wb]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.03


def test_signature_estimates_large_weights():
    """Weights over 100 in both, in one, and in neither: split processes see the same points whatever the weight."""
    rng = np.random.default_rng(2)
    s = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
    for high in ((1, 3), (100, 400), (1, 1000), (600, 700)):
        wa, wb = rng.integers(*high, 40), rng.integers(*high, 40)
        sig = bagminhash.signatures(np.repeat([0, 1], 40), np.concatenate([s, s]), np.concatenate([wa, wb]), 2, 4096)
        assert abs((sig[0] == sig[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.03
    subset = bagminhash.signatures(np.repeat([0, 1], [1, 1]), s[[0, 0]], np.array([130, 520]), 2, 4096)
    assert abs((subset[0] == subset[1]).mean() - 0.25) < 0.03


def clashing(df):
    """Columns with the operators' inner names."""
    for c in ("pos", "row", "hash", "label", "g", "w0", "diag", "h1", "key", "v", "__key", "__d", "__k", "__w", "__row", "start", "end", "doc", "n"):
        df = df.withColumn(c, F.lit(c))
    return df


def test_clashing_columns(spark, odd):
    d = clashing(odd.drop("score"))
    n = odd.count()
    out = license_scan.spans(d)
    assert out.count() == n and {r["pos"] for r in out.collect()} == {"pos"} and "__w" in out.columns
    out = line_dedup.dedup_lines(d.drop("__row"))
    assert out.count() == n and {(r["row"], r["h1"]) for r in out.collect()} == {("row", "h1")}
    out = bagminhash.dedup(d)
    assert out.columns == d.columns and {(r["__key"], r["v"]) for r in out.collect()} == {("__key", "v")}
    assert suffix_dedup.dedup_substrings(d).count() == n
    assert language_crf.tag(d, None).count() == n


def test_near_duplicates(spark, real, odd):
    base = " ".join(f"term{i * i % 97}x{i}" for i in range(200))
    copies = [(900 + k, base.replace(f"x{k * 11} ", f"y{k} ").replace(f"x{k * 7 + 90} ", f"z{k} "), None, None, None) for k in range(15)]
    docs = real.select("doc_id", "text").unionByName(spark.createDataFrame(copies, DOCS).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bags = bags_of(texts)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = sum((bags[a] & bags[b]).values())
            if texts[a] == texts[b] or (both and both >= 0.8 * sum((bags[a] | bags[b]).values())):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(docs).collect()}
    assert got == {i: find(i) for i in ids}
    kept = [r["doc_id"] for r in bagminhash.dedup(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, None, 5, 6, 7], key=str)
    assert bagminhash.classes(empty(spark)).count() == 0


def test_lines(spark, real, odd):
    docs = [(2, "one two three four five six\nshort\nalpha beta gamma delta epsilon"), (1, "one two three  FOUR five six\nother words that are unique here\none two three four five six"), (3, None), (4, "x y. alpha beta gamma delta epsilon zeta eta theta. Tail words stay"), (5, "Head words. Alpha beta gamma delta epsilon zeta eta theta. End of it all")]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1]["text"] == "one two three  FOUR five six\nother words that are unique here\n"
    assert got[2]["text"] == "short\nalpha beta gamma delta epsilon" and [tuple(x) for x in got[2]["removed"]] == [(0, 28)]
    assert got[3]["text"] is None and got[4]["n_removed"] == 0
    assert got[5]["text"] == "Head words. End of it all"
    seen, expected = set(), {}
    for r in real.orderBy("doc_id").collect():
        spans, mine = [], list(line_dedup.units_of(r["text"] or "", 5, 8))
        for a, b, d in mine:
            if d in seen:
                spans.append((a, b))
            seen.add(d)
        expected[r["doc_id"]] = line_dedup.drop_spans(r["text"], spans)
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(real).collect()} == expected
    assert line_dedup.dedup_lines(odd.withColumn("removed", F.lit(1))).count() == 8
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_short_lines(spark, tmp_path):
    """The query and the pipeline's stage hash lines of one word and more, and sentences of four words and more."""
    docs = [(1, "All rights reserved.\nOne.\nfirst text of its own\n\n"), (2, "One.\nall  rights RESERVED.\nHead of it. Yes. Four words stand here. Tail one\n\n"), (3, "Begin. Yes. Four words stand here. Tail two")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {1: docs.first()["text"], 2: "Head of it. Yes. Four words stand here. Tail one\n\n", 3: "Begin. Yes. Tail two"}
    assert {r["doc_id"]: r["text"] for r in line_dedup.op5_line_hashing(spark, str(tmp_path)).collect()} == want
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_lines(spark, docs, str(tmp_path)).collect()} == want


def removed_by_brute_force(raws, window):
    seen = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if seen[r[i : i + window]] > 1:
                gone[i : i + window] = True
        left = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return out


def test_deep_shallow_sorts():
    rng = np.random.default_rng(2)
    strings = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in rng.integers(0, 90, 400)] + [b"a" * 70, b"a" * 80, b"a" * 80, b""]
    keys = rng.integers(0, 3, len(strings))
    order, common = suffix_dedup.deep_shallow(keys, strings)
    got = [(keys[i], strings[i]) for i in order]
    assert got == sorted(got)
    for p in range(1, len(got)):
        a, b = got[p - 1], got[p]
        want = -1 if a[0] != b[0] else next((k for k in range(min(len(a[1]), len(b[1]))) if a[1][k] != b[1][k]), min(len(a[1]), len(b[1])))
        assert common[p] == want


def test_minimisers_do_not_depend_on_the_chunk():
    """The same bytes choose the same places alone, later in a long chunk, and beside other documents; of equal grams the left one."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 101, 900).astype(np.uint8)
    text[300:640] = 97  # equal grams side by side
    alone = suffix_dedup.runs_of(text, np.array([0]), 200, 32)
    for before in (1, 7, 1000, 5_003, 300_000):
        joined = np.concatenate([rng.integers(0, 256, before).astype(np.uint8), text])
        got = suffix_dedup.runs_of(joined, np.array([0, before]), 200, 32)
        mine = got[0] >= before
        assert [tuple(x[mine] - (before if k == 0 else 0)) for k, x in enumerate(got[:3])] == [tuple(x) for x in alone[:3]] and (got[3][mine] == alone[3]).all()
    assert (alone[3] == suffix_dedup.gram_hashes(text, 32)[alone[0] + alone[2]]).all()


@pytest.mark.parametrize("chunk", [1_000, 7_777, 400_000])
def test_substrings_with_small_chunks(spark, real, chunk, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    monkeypatch.setattr(suffix_dedup, "BATCH", 50 if chunk < 5000 else 5_000)
    docs = real.select("doc_id", "text").limit(120)
    rows = docs.collect()
    expected = removed_by_brute_force([(r["text"] or "").encode() for r in rows], 200)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.dedup_substrings(docs).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], expected, strict=True))


@pytest.mark.parametrize("block", [2000, 3])
def test_substrings(spark, real, odd, block):
    rng = np.random.default_rng(3)
    word = lambda: "".join(chr(c) for c in rng.integers(97, 123, 7))
    shared = " ".join(word() for _ in range(60))
    made = [(1000 + k, " ".join(word() for _ in range(20)) + shared[: 210 + 20 * k] + " é " + " ".join(word() for _ in range(20)), None, None, None) for k in range(12)]
    made += [(2000, "ab" * 300, None, None, None), (2001, "x" * 199, None, None, None), (2002, "x" * 199, None, None, None)]
    docs = real.select("doc_id", "text").limit(120).unionByName(spark.createDataFrame(made, DOCS).select("doc_id", "text")).unionByName(odd.select("doc_id", "text")).cache()
    rows = docs.collect()
    expected = removed_by_brute_force([(r["text"] or "").encode() for r in rows], 200)
    ranges = suffix_dedup.repeated_ranges(docs.select("text"), 200, block=block)
    assert ranges.count() >= 0
    got = suffix_dedup.dedup_substrings(docs).collect() if block == 2000 else None  # the production block is larger still
    if got:
        key = lambda x: tuple(map(str, x))
        assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=key) == sorted(((r["doc_id"], *e) for r, e in zip(rows, expected, strict=True)), key=key)
    else:  # blocks of a few runs find the same
        covered = lambda rs: sorted((bytes(r["id"]), w) for r in rs.collect() for w in range(r["start"], r["start"] + r["windows"]))
        assert set(covered(ranges)) == set(covered(suffix_dedup.repeated_ranges(docs.select("text"), 200)))
    assert suffix_dedup.dedup_substrings(empty(spark)).count() == 0

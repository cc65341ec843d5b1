"""Vectors, urls, packing, mixing and the pipeline on small fixtures."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import anisotropic_search, curriculum, lattice_dedup, line_dedup, packing, url_filter

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, kept string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 64))
    x[300:600] = x[:300] + 0.1 * rng.normal(size=(300, 64))
    rows = [(i, [float(np.float32(c)) for c in v], i % 3, "x") for i, v in enumerate(x)]
    rows += [(1000 + i, rows[7][1], 1, None) for i in range(5)] + [(1007, rows[7][1], None, "x"), (1007, rows[7][1], 1, "x")]
    bad = [None, [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] * 64, []]
    rows += [(2000 + 50 * i, v, 1, "x") for i, v in enumerate(bad)]
    return spark.createDataFrame(rows, VECTORS)


def usable(rows):
    return [(r["vec_id"], np.array(r["embedding"], float), r["label"]) for r in rows if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"]) and any(r["embedding"])]


def test_search(spark, vectors):
    rows = usable(vectors.collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in anisotropic_search.search(vectors.select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, row_block=200, query_block=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        best = sorted((-round(c, 12), i) for n, (c, i) in enumerate(zip(s, ids, strict=True)) if n != q)[:5]
        found = sorted(got[ids[q]])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in best} & {i for _, i, _ in found})
        total += 5
    assert hits / total >= 0.9 and set(got) == set(ids[ids % 50 == 0])
    few = vectors.where("vec_id IN (0, 1, 2)").select("vec_id", "embedding")
    assert anisotropic_search.search(few, F.col("vec_id") == 0).count() == 2
    assert anisotropic_search.search(few.limit(0), F.col("vec_id") == 0).count() == 0
    odd = few.unionByName(few.withColumn("vec_id", F.lit(None).cast("long"))).withColumn("score", F.lit(1))
    found = anisotropic_search.search(odd, F.col("vec_id") == 0).orderBy("rank").collect()
    assert len(found) == 5 and found[0]["vec_id"] is None and found[0]["score"] == pytest.approx(1) and {r["vec_id"] for r in found} == {None, 1, 2}


def test_search_among_near_copies(spark):
    """A third of the rows are distinct near copies of one centre: their codes are nearly alike, and the search is exact all the same."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64))
    x[::3] = x[0] + 0.03 * rng.normal(size=(500, 64))
    x = x.astype(np.float32).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in anisotropic_search.search(rows, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = {True: [], False: []}
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        s[q] = -2
        hits[q % 3 == 0].append(len(set(np.argsort(-s, kind="stable")[:5]) & got[q]) / 5)
    assert np.mean(hits[True]) == 1 and np.mean(hits[False]) == 1


def test_lattice(spark, vectors):
    rng = np.random.default_rng(6)
    y = rng.normal(size=(200, 8)) * 2
    p = lattice_dedup.decode(y)
    roots = lattice_dedup.roots()
    own = ((y - p) ** 2).sum(axis=1)
    assert len(roots) == 240 and (own <= 1 + 1e-9).all()  # the lattice's covering radius
    assert all((own <= ((y - p - g) ** 2).sum(axis=1) + 1e-9).all() for g in roots)
    rows = [r for r in usable(vectors.collect()) if r[2] is not None]
    x = np.array([r[1] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = lattice_dedup.near_duplicates(vectors).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(lattice_dedup.near_duplicates(vectors, block=7).collect(), key=key)
    assert len(got) == vectors.count()
    found, all_links = sum(r["n_links"] for r in got), near.sum()
    assert 0.99 * all_links <= found <= all_links
    sevens = [r for r in got if r["vec_id"] >= 1000 and r["vec_id"] < 1007]
    assert {r["component_id"] for r in sevens} == {7} and {r["n_links"] for r in sevens} == {7}  # six copies, and row 307 that was made from it
    assert all(r["n_links"] == 0 and r["component_id"] == r["vec_id"] for r in got if r["vec_id"] >= 2000)
    assert lattice_dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_urls(spark):
    urls = ["https://A.example.net/en/1", "http://x.NET/?q", "http://x.net", "http://example.com/de/1", "http://my.example.com/DE/", "ftp://w.org/fr/x?y", None, "no scheme", "http://a.com/cheap-pills", "http://a.com/cheappills", "http://a.com/bets/bonus", "http://a.com/bets", "http://notexample.com/de/1", "https://spam-farm.example.org/fr/1", ""]
    got = url_filter.judge(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [
        ("example.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"),
        (None, "block"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"), ("org/fr/", "allow"), (None, "allow"),
    ]
    assert (got[0]["host"], got[0]["path"], got[1]["path"], got[6]["host"]) == ("a.example.net", "/en/1", "/", "")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    pages = spark.createDataFrame([(1, "http://a.com/Foo/bar"), (2, "http://a.com/bar?foo2"), (3, "http://a.com/" + "x/" * 50_000 + "evil"), (3, None)], "page_id long, url string").withColumn("weight", F.lit("w")).withColumn("__n", F.lit(1))
    words = spark.createDataFrame([("FOO", 0.6), ("bar", 0.4), ("evil", 1.0), ("bar", 0.1), (None, 1.0), ("", 1.0)], "term string, weight double")
    assert [r["verdict"] for r in url_filter.judge(pages, vocabulary=words).collect()] == ["block", "allow", "block", "allow"]
    assert {r["verdict"] for r in url_filter.judge(pages, vocabulary={}).collect()} == {"allow"}


def test_packing(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "a<|endoftext|>b"), (1003, "日本　語 \x1c\x85 x"), (None, "null id"), (1004, "w " * 5000), (1004, "w " * 5000)], "doc_id long, text string")
    docs = real.unionByName(odd)
    got = packing.pack_documents(docs).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in docs.collect():
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        short = len(ids) % 1024
        cuts = [*([0] if short else []), *range(short, len(ids) + 1, 1024)]
        expected += [(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(expected, key=key)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.01 * -(-sum(r["length"] for r in got) // 1024) + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1024, 300)
    a, b = packing.best_fit(np.arange(300), sizes, 1024), packing.best_fit(np.arange(299, -1, -1), sizes, 1024)
    child = packing.crossover(a, b, sizes, 1024, rng)
    for p in (a, b, child):
        assert (p.bin_of >= 0).all() and (np.bincount(p.bin_of, sizes) == p.used).all() and p.used.max() <= 1024
    best = packing.evolve(sizes, 1024, None, 4, 12, rng)
    assert len(best.used) <= min(len(a.used), len(b.used)) and (np.bincount(best.bin_of, sizes) == best.used).all()


def test_mix(spark):
    docs = [(i, "w " * (i % 50 + 1), None if i % 10 == 9 else f"s{i % 4}", "x") for i in range(400)] + [(400, None, "s1", "x"), (None, "a b", "s2", "x"), (5, "w " * 6, "s1", "x"), (5, "w " * 6, "s1", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, size string")
    rows = curriculum.mix(d).collect()
    assert len(rows) == len(docs) and sorted(str(r) for r in rows) == sorted(str(r) for r in curriculum.mix(d).collect())
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        s = by.setdefault(r["source"], [0, r["source_size"], r["target"], 0, 0])
        s[0] += r["size"]
        s[3] += r["taken"]
        s[4] = max(s[4], r["size"])
        assert r["taken"] <= 2 * r["size"]
    assert all(s[0] == s[1] and s[2] <= 2 * s[1] + 1e-6 and abs(s[3] - s[2]) <= s[4] for s in by.values())
    assert abs(sum(s[2] for s in by.values()) - 1.5 * total) < 1e-6
    places = [r["position"] for r in rows if r["position"] is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert curriculum.stream(d).count() == sum(r["copies"] for r in rows)
    assert curriculum.mix(d.limit(0)).count() == 0


@pytest.mark.parametrize(("module", "query"), [(curriculum, curriculum.op10_curriculum_mix), (url_filter, url_filter.op7_url_vocabulary)])
def test_against_sql(spark, module, query):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.sql(module.ORACLE)
    got = query(spark, SF).select(*want.columns)
    plain = lambda rows: sorted((tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in rows), key=str)
    assert plain(got.collect()) == plain(want.fetchall())


def duck(docs):
    c = duckdb.connect()
    c.register("documents", docs.toArrow())
    return c


def test_pipeline(spark):
    """Each stage against another way to its result, on what the one before it has kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    foreign = spark.createDataFrame([(90001, "Привет мир это обычный русский текст о погоде", "en", "src0", 45), (90002, "これは日本語の文章です", "en", "src0", 11), (90003, "12 !! 34", "en", "src0", 8), (90004, None, "en", "src0", None)], docs.schema)
    spoken = stages["language"](spark, docs.unionByName(foreign), SF).select(*columns).cache()
    assert spoken.columns == columns and ids(spoken) == ids(docs.where(F.col("text").rlike(r"\p{L}")))

    apart = stages["near_duplicates"](spark, spoken, SF).cache()
    texts = {r["doc_id"]: r["text"] for r in spoken.collect()}
    words = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    bags = {i: Counter(" ".join(w[j : j + 5]) for j in range(max(len(w) - 4, 1))) for i, w in words.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(texts)
    for n, a in enumerate(order):
        for b in order[:n]:
            if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert apart.columns == columns and ids(apart) == [i for i in order if find(i) == i]

    cut = stages["repeated_lines"](spark, apart, SF).cache()
    want = duck(apart).sql(f"SELECT doc_id, text FROM ({line_dedup.ORACLE}) WHERE n_removed = 0 OR regexp_matches(text, '\\S')").fetchall()
    assert cut.columns == columns and sorted((r["doc_id"], r["text"]) for r in cut.collect()) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    stream = stages["curriculum_mix"](spark, cut, SF).cache()
    want = duck(cut).sql(f"SELECT doc_id, taken // greatest(size, 1) FROM ({curriculum.ORACLE}) WHERE taken > 0").fetchall()
    assert stream.columns == columns and Counter(ids(stream)) == Counter(dict(want))

    out = stages["packed"](spark, stream, SF).collect()
    many = Counter((r["doc_id"], r["piece"]) for r in out)
    taken = Counter(ids(stream))
    assert all(many[i, 0] == n for i, n in taken.items()) and {i for i, _ in many} == set(taken)
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert len(sequences) <= 1.02 * -(-sum(r["length"] for r in out) // 1024) + 1


def test_stages_on_odd_rows(spark):
    """Nulls in every column, blank and long texts, repeated rows, an empty table, and extra columns named like the operators' own."""
    line = "these words are the same in all of the rows. "
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", None, None, 3), (None, "a text without an id but with several words in it", "en", "a", 49), (5, line * 9, "en", "a", 405), (5, line * 9, "en", "a", 405), (6, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(17000)), None, None, 1), (7, "12 34 !!", "en", None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("score", "support", "lang_pred", "n_removed", "removed", "row", "key", "size", "taken", "position", "label", "piece"):
        docs = docs.withColumn(c, F.lit(c))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        found = out.collect()
        assert out.columns == docs.columns and all(r["row"] == "row" and r["removed"] == "removed" and r["score"] == "score" and r["size"] == "size" for r in found), name
        kept[name] = sorted((r["doc_id"] for r in found), key=str)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {1, 2, 3, 7}.isdisjoint(kept["language"]) and {5, None} <= set(kept["language"])
    assert kept["near_duplicates"] == [1, 2, 3, 5, 6, 7, None]
    assert kept["repeated_lines"] == [1, 2, 3, 5, 6, 7, None]
    assert set(kept["curriculum_mix"]) <= {1, 2, 3, 5, 6, 7, None}
    packed = corpus_pipeline.packed(spark, docs, SF)
    pieces = packed.collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r[0] for r in rows)
    assert corpus_pipeline.packed(spark, docs.limit(0), SF).count() == 0


def test_run_leaves_only_what_it_needs(spark, tmp_path):
    from tallybook.llm import common

    before = common.kept_tables()
    assert corpus_pipeline.run(spark, SF).count() > 100
    left = common._kept[before:]
    assert not any("/bag-" in p or "/line-" in p or "stage-language" in p for p in left) and any("stage-curriculum_mix" in p for p in left)

"""Centroid clustering, piece encoding and fill-in-the-middle on small fixtures."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallybook.llm import drift_clustering as drift
from tallybook.llm import fill_in_middle as fim
from tallybook.llm import sentencepieces as sp
from tallybook.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n int, form string, ids string"


def plain_means(rows, k, rounds, scale=256, dims=64):
    """The clustering by loops over Python's whole numbers: (id, cluster, distance) in order, and the centroids."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v):
            limit = 2 ** int(np.log2((2**61 / dims) ** 0.5))
            kept.append((vec_id, [int(np.floor(min(max(scale * float(c), -limit), limit))) for c in v]))
    place = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=place)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), j) for j, p in enumerate(points))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(points)):
            mine = [v for (_, v), c in zip(kept, of, strict=True) if c == j]
            if mine:
                points[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    return sorted(out, key=str), points


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").coalesce(3)


def test_clusters_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 64))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.4 * rng.normal(size=64)], "x") for i in range(700)]
    rows += [(i, rows[5][1], None) for i in range(1000, 1040)] + [(7, rows[7][1], "x"), (None, rows[8][1], "x")]  # ties and repeated rows
    rows += [(2000, None, ""), (2001, [1.0] * 63, ""), (2002, [None] + [1.0] * 63, ""), (2003, [float("nan")] + [1.0] * 63, ""), (2004, [float("-inf")] * 64, ""), (2005, [], ""), (2006, [0.0] * 64, ""), (2007, [1e300, -1e300] * 32, "")]
    expected, points = plain_means([(i, v) for i, v, _ in rows], 9, 4)
    found = drift.cluster(vectors(spark, rows), k=9, rounds=4)
    assert sorted([tuple(r) for r in found.rows.collect()], key=str) == expected
    assert found.points.tolist() == points


def test_bounds_hold_and_scan_less(spark):
    """Every fall in distance is below its bound, bounds are below the full drift, and they spare scans."""
    rng = np.random.default_rng(8)
    old = rng.integers(-100, 100, (15, 8))
    new = old + rng.integers(-40, 40, (15, 8))
    radii = rng.uniform(1, 150, 15)
    bound = drift.falls(old, new, radii)
    way = np.linalg.norm(new - old, axis=1)
    assert (bound <= way[None, :] + 1e-9).all() and bound.mean() < 0.8 * way.mean()
    for i in range(15):
        step = rng.normal(size=(4000, 8))
        inside = old[i] + step / np.linalg.norm(step, axis=1)[:, None] * radii[i] * rng.random((4000, 1)) ** 0.125
        for j in range(15):
            assert (np.linalg.norm(inside - old[j], axis=1) - np.linalg.norm(inside - new[j], axis=1)).max() <= bound[i, j] + 1e-9
    centres = rng.normal(size=(30, 64))
    rows = vectors(spark, [(i, [float(x) for x in centres[i % 30] + rng.choice([0.1, 0.3]) * rng.normal(size=64)], None) for i in range(1500)])
    tight, full = drift.cluster(rows), drift.cluster(rows, full_drift=True)
    assert sorted(map(tuple, tight.rows.collect())) == sorted(map(tuple, full.rows.collect()))
    assert sum(tight.scanned[1:]) < 0.9 * sum(full.scanned[1:]) < 0.5 * 5 * 1500


def test_clustering_of_few_or_no_vectors(spark):
    few = vectors(spark, [(1, [0.5] * 64, None), (2, [-0.5] * 64, None)])
    assert {r["distance"] for r in drift.cluster(few).rows.collect()} == {0}
    assert drift.cluster(few.limit(0)).rows.count() == 0
    one = drift.cluster(few.where("vec_id = 1"), k=1, rounds=2)
    assert [tuple(r) for r in one.rows.collect()] == [(1, 0, 0)]


def test_clustering_by_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = [tuple(r[c] for c in columns) for r in QUERIES["op11_drift_clustering"](spark, SF).collect()]
    assert sorted(got) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({drift.ORACLE})").fetchall())


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(1)
    letters = "  ▁▁abcdeABC012.,\n\t\x00éßžяéÀ日本語한글🙂🚀ﬁ​ ﻿²½ा"
    return ["", " ", "   ", "▁", "a", "<s>", "<0x41>", "x" * 3000, " " * 700, "日本" * 500, "a,b" * 400, *["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]]


def test_pieces_are_the_library_s(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = odd_texts()
    for text, ids in zip(texts, library.encode(texts, num_threads=1), strict=True):
        assert pieces.encode(text) == ids
        assert pieces.merged(pieces.normalize(text)) == ids  # one agenda for the whole text
        assert pieces.decode(ids) == library.decode(ids)
    assert all(agrees for _, _, agrees in pieces.checked(texts))
    rng = random.Random(2)
    for _ in range(4000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(262) for _ in range(rng.randrange(12))]
        assert pieces.decode(ids) == library.decode(ids)


def test_differences_give_way_to_the_library(pieces, monkeypatch):
    monkeypatch.setattr(pieces, "merged", lambda text: [0] * len(text))
    pieces.known.clear()
    pieces.older.clear()
    (ids, text, agrees), (none, empty, right) = pieces.checked(["new words", ""])
    assert not agrees and text == "new words" and ids == pieces.library.encode("new words") and none == [] and empty == "" and right
    pieces.known.clear()


def test_piece_query_and_operators(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(1, None, 1, "a", "x"), (2, "", 1, "a", "x"), (3, "two words", 1, "a", "x"), (3, "two words", 1, "a", None), (None, "é🙂\n", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted([(r["doc_id"], r["ids"], r["agrees"]) for r in sp.encode(docs).collect()], key=str)
    assert got == sorted([(i, library.encode(t or ""), True) for i, t, *_ in rows], key=str)
    back = sp.decode(sp.encode(docs)).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in back], key=str) == sorted([(i, t or "") for i, t, *_ in rows], key=str)
    assert sp.encode(docs.limit(0)).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op12_piece_agenda"](spark, SF).collect()
    assert len(out) == len(texts) and all(r["agrees"] for r in out)
    for r in out:
        ids = library.encode(texts[r["doc_id"]])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def plain_middle(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_middles_are_those_of_plain_slices(spark):
    rng = random.Random(4)
    shared = "".join(rng.choice("abc dé日🙂\n") for _ in range(6000))
    texts = [None, "", "a", "🙂", "<P>", "a<S>b", "<M", "<<P", shared, shared[100:], "é" + shared, shared * 40, "a" * 50_000, "日" * 20_000, *["".join(rng.choice("<PSM>é日🙂 a") for _ in range(rng.randrange(30))) for _ in range(500)]]
    rows = [(i, t, 1, "x", "y") for i, t in enumerate(texts)] + [(3, shared, 1, "x", None), (None, shared, None, None, None)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, DOCS).coalesce(2)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(i, *plain_middle(i, t or ""), t or "") for i, t, *_ in rows], key=str)
    assert fim.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0


def test_chunks_are_defined_by_content():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 110, 200_000).astype(np.uint8)
    ends = fim.chunk_ends(data)
    assert 200 < np.diff(ends).mean() < 1200 and np.diff(ends).max() <= fim.LONGEST
    moved = fim.chunk_ends(np.concatenate([data[:777], data]))
    assert len(np.intersect1d(ends, moved - 777)) > 0.98 * len(ends)  # what is shared is cut at the same places
    small = fim.BLOCK
    try:
        fim.BLOCK = 1000
        assert np.array_equal(fim.chunk_ends(data), ends)
    finally:
        fim.BLOCK = small
    constant = fim.chunk_ends(np.full(100_000, 97, np.uint8))
    assert constant[-1] == 100_000 and np.diff(constant, prepend=0).max() <= fim.LONGEST


def test_words_as_units():
    """Words that go on across chunks count once; every cut is where a word begins."""
    rng = random.Random(9)
    text = "".join(rng.choice("ab é\n  ") for _ in range(30_000)).encode()
    index = fim.Counter("word").index(text)
    begins = [i for i in range(len(text)) if not text[i : i + 1].isspace() and (i == 0 or text[i - 1 : i].isspace())]
    assert index.n == len(begins) == len(text.split())
    assert [index.place(u) for u in range(1, index.n)] == begins[1:] and index.place(index.n) == len(text) and index.place(0) == 0


def test_few_vectors_are_scored_exactly():
    """Of random directions, the worst case for bounds, the second codes leave under a twentieth; the first bound alone nearly half."""
    from tallybook.llm import anisotropic_search as search

    rng = np.random.default_rng(2)
    x = search.parts(search.unit(rng.normal(size=(2000, 64))))
    eta = 63 * 0.04 / 0.96
    books = search.train(x, eta)
    codes = search.encode(x, books, eta)
    left = search.residual(x, books, codes)
    second = search.train(left, 1.0)
    codes2 = search.encode(left, second, 1.0, 0)
    flat, left, last = (v.reshape(len(x), -1) for v in (x, left, search.residual(left, second, codes2)))
    queries = flat[::50]
    sixth = np.sort(queries @ flat.T, axis=1)[:, -6, None]
    share = [((queries @ (flat - e).T + np.linalg.norm(e, axis=1)) >= sixth).mean() for e in (left, last)]
    assert share[0] > 0.2 and share[1] < 0.05
    table, table2 = (np.einsum("pi,pki->pk", x[0], b).astype(np.float32) for b in (books, second))
    assert np.allclose(search.sums(table, codes) + search.sums(table2, codes2), (flat - last) @ flat[0], atol=1e-4)
    assert np.array_equal(search.unpack(search.pack(codes))[:, : codes.shape[1]], codes)


def test_centroids_are_refitted_to_a_smaller_loss():
    from tallybook.llm import anisotropic_search as search

    rng = np.random.default_rng(3)
    x = search.parts(search.unit(rng.normal(size=(600, 12))))
    eta = 5.0
    books = search.train(x, eta, rounds=0)
    codes = search.encode(x, books, eta)

    def loss():
        e = search.residual(x, books, codes)
        return (e**2).sum() + (eta - 1) * ((e * x).sum(axis=(1, 2)) ** 2).sum()

    before = loss()
    search.refit(x, books, codes, eta)
    least = loss()
    assert least < before
    for _ in range(60):
        search.refit(x, books, codes, eta)
    best = loss()
    for _ in range(30):  # at the least loss no small step helps
        step = 1e-3 * rng.normal(size=books.shape)
        books += step
        assert loss() >= best - 1e-9
        books -= step


def crf_log_likelihood(model, words, labels, first):
    """By loops over the words, in logarithms."""
    from tallybook.llm import language_crf as crf

    e = np.asarray(model.weights, float)[crf.gram_features(words)].sum(axis=1) + model.lexicon[crf.lexicon_buckets(words)].astype(float) @ model.lexicon_weights + model.bias
    total, before = 0.0, None
    for i, y in enumerate(labels):
        if first[i]:
            total -= np.logaddexp.reduce(before) if before is not None else 0.0
            before = model.start + e[i]
            total += model.start[y] + e[i, y]
        else:
            total += model.transitions[labels[i - 1], y] + e[i, y]
            before = np.array([np.logaddexp.reduce(before + model.transitions[:, j]) for j in range(len(before))]) + e[i]
    return total - np.logaddexp.reduce(before)


def test_language_gradient_is_that_of_finite_differences():
    """The first step of the fit tells its gradient; it is the slope of the regularised likelihood."""
    from tallybook.llm import language_crf as crf

    docs = [(["the", "house", "of", "the", "river"] * 4, 0), (["la", "maison", "de", "la", "riviere"] * 4, 1), (["a", "river", "house"] * 5, 0)]
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (1 << crf.LEXICON_BITS, 2)).astype(float)
    begun, moved = crf.fit(docs, ["en", "fr"], counts, rounds=0), crf.fit(docs, ["en", "fr"], counts, rounds=1)
    words, labels, first = crf.training_sequence(docs + crf.made_words(docs, 2))
    grams = np.unique(crf.gram_features(words))
    cells = [("bias", (j,)) for j in range(3)] + [("start", (j,)) for j in range(3)] + [("transitions", (i, j)) for i in range(3) for j in range(3)] + [("lexicon_weights", (i, j)) for i in range(begun.lexicon_weights.shape[0]) for j in range(3)]
    cells += [("weights", (int(g), j)) for g in rng.choice(grams[grams > 0], 12, replace=False) for j in range(3)]
    begun.weights = begun.weights.astype(float)
    for name, at in cells:
        values = getattr(begun, name)
        step = float(getattr(moved, name)[at]) - float(values[at])
        told = step * 1e-4 / np.sqrt(0.09 - step**2)  # the step is 0.3 g / sqrt(g^2 + 1e-8)
        old, slopes = float(values[at]), []
        for h in (1e-4, -1e-4):
            values[at] = old + h
            slopes.append(crf_log_likelihood(begun, words, labels, first) / len(words) - 1e-4 / 200 * (old + h) ** 2)
        values[at] = old
        assert told == pytest.approx((slopes[0] - slopes[1]) / 2e-4, rel=0.02, abs=2e-6), (name, at)


def test_language_of_one_document_by_loops(spark):
    """Means of all words' label probabilities, each from sums over all ways to label the words before and behind."""
    from tallybook.llm import language_crf as crf

    model = crf.train(spark.read.parquet(f"{SF}/documents.parquet"), 100)
    text = "The house and la maison, und das haus 123 x " * 3
    words = crf.tokens(text)
    e = model.weights[crf.gram_features(words)].astype(float).sum(axis=1) + model.lexicon[crf.lexicon_buckets(words)].astype(float) @ model.lexicon_weights + model.bias
    n, k = e.shape
    ahead, behind = [model.start + e[0]], [np.zeros(k)]
    for i in range(1, n):
        ahead.append(np.array([np.logaddexp.reduce(ahead[-1] + model.transitions[:, j]) for j in range(k)]) + e[i])
        behind.append(np.array([np.logaddexp.reduce(model.transitions[j] + e[n - i] + behind[-1]) for j in range(k)]))
    both = np.array(ahead) + np.array(behind[::-1])
    mean = np.exp(both - np.logaddexp.reduce(both, axis=1)[:, None]).mean(axis=0)
    got = crf.tag(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert got["lang_pred"] == model.langs[int(mean[:-1].argmax())] and got["score"] == pytest.approx(mean[:-1].max(), abs=1e-4) and got["support"] == pytest.approx(1 - mean[-1], abs=1e-4)


def test_both_tokenisers_agree_on_plain_texts():
    from tokenizers import Tokenizer

    from tallybook.llm.packing import Ids

    ids = Ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    letters = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x250), *range(0x2018, 0x201F)]))
    for _ in range(6000):
        some = rng.choice((letters, "abcde  \n'’.12", "aàbß '"))
        text = "".join(rng.choice(some) for _ in range(rng.randrange(60)))
        assert ids(text).tolist() == other.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("long", [200, 333, 1_000_000])
def test_long_texts_are_scanned_in_pieces(spark, long, monkeypatch):
    """Whatever the pieces, what is removed is what brute force removes, also from one long text that repeats itself."""
    from tallybook.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "LONG", long)
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    shared = noise(700)
    texts = [noise(3000) + shared + noise(1500) + shared[:450] + noise(900) + "z" * 650, noise(100) + shared[200:600], noise(199), "q" * 200, None, ""]
    raws = [(t or "").encode() for t in texts]
    places = {}
    for i, raw in enumerate(raws):
        for at in range(len(raw) - 199):
            places.setdefault(raw[at : at + 200], []).append((i, at))
    gone = [bytearray(len(raw)) for raw in raws]
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                gone[i][at : at + 200] = b"\x01" * 200
    kept = [hashlib.sha256(bytes(c for c, g in zip(raw, flags, strict=True) if not g)).hexdigest() for raw, flags in zip(raws, gone, strict=True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in suffix_dedup.dedup_substrings(docs).collect()}
    assert got == {i: (sum(flags), kept[i]) for i, flags in enumerate(gone)} and 0 < sum(gone[0]) < len(raws[0])

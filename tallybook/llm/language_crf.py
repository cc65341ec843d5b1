"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets one label per language. A word's score is the sum of learned weights of its affixes and character
n-grams (hashed to a fixed table) and of lexicon features: the log share of each language among the training words in the
word's hash bucket, counted by Spark over all training documents outside the fit sample. Learned transitions join
neighbouring words, and forward-backward gives each word's label probabilities, so that code-switched text is labelled
word by word. One more label stands for words of no learned language; it is learned from made words (letters of the sample
in random order, and letters of random scripts). A document's language is the learned one with the largest mean probability;
that mean is its score, and its support is the mean probability that a word is of any learned language.

Fitting uses a bounded sample on the driver: about ``fit_docs`` rows in all, dealt evenly to the languages, of each the first by a hash of
doc_id and text, and at most half of its rows; rows that agree in id, text and language are learned from once. The lexicon counts all rows beyond a language's
last sampled hash. Only the hash, text and lang of training rows are read. Since labels are known by document, training
sequences are cut from documents of all languages in turn, which is where transitions are learned from.
The lexicon has ``2**LEXICON_BITS`` buckets whatever the input; all texts are read whole, in chunks of about half a million
characters, by one Python task per partition. Nothing is shuffled but lexicon counts. Languages are taken to be few (hundreds):
the model, the counts and the sample grow with their number, not with the rows.

Edge cases: null text, and text without a letter, is ``und`` with score 0; so is everything if no training row exists;
a null doc_id is neither held out nor learned from; null lang is not learned from; very long texts are labelled whole;
a run of more than 30 letters is taken as several words of 30, and one in a script without blanks as words of two letters;
ties go to the smaller language name; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import table, text_batches

FEATURE_BITS, LEXICON_BITS, WIDTH, CHUNK, KNOWN, BLOCK = 16, 17, 32, 500_000, 200_000, 40_000
#: Thai, Lao, Burmese, Khmer, Kana, Bopomofo and Han are written without blanks.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W\d_{_UNSPACED}]{{1,{WIDTH - 2}}}|(?:(?![\W\d_])[{_UNSPACED}]){{1,2}}")


class Vocabulary(dict):
    """word -> number; a new word gets the next number."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def tokens(text: str | None) -> list[str]:
    """Runs of letters, longer ones in pieces of WIDTH - 2, in scripts without blanks of two; no letter is left out."""
    return _WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points [n, WIDTH] of the words between a start and an end mark, and their lengths."""
    marked = ["^" + w + "$" for w in words]
    chars = np.array(marked, dtype=f"U{WIDTH}").view(np.uint32).reshape(len(words), WIDTH).astype(np.uint64)
    return chars, (chars != 0).sum(axis=1)


def _number(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x51ED2701)) * _MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def lexicon_buckets(words: list[str]) -> np.ndarray:
    """Lexicon buckets [n] of distinct words of at most WIDTH - 2 letters."""
    if not words:
        return np.zeros(0, np.int64)
    chars, length = _letters(words)
    whole = np.zeros(len(words), np.uint64)
    for i in range(int(length.max())):
        whole = np.where(i < length, (whole ^ chars[:, i]) * _MIX, whole)
        whole ^= whole >> np.uint64(31)
    for _ in range(int(length.max()), WIDTH):
        whole ^= whole >> np.uint64(31)
    return _number(whole, 99, LEXICON_BITS)


def gram_features(words: list[str]) -> np.ndarray:
    """Feature numbers [n, k] of the n-grams and affixes of distinct words of at most WIDTH - 2 letters; 0 means none."""
    chars, length = _letters(words)
    grams = chars.copy()
    columns, rows = [], np.arange(len(words))
    used = max(int(length.max()), 4) if len(words) else 4
    for n in (2, 3):
        grams = grams[:, : WIDTH - n + 1] * np.uint64(0x100000001B3) + chars[:, n - 1 :]
        f = _number(grams[:, : used - n + 1], n, FEATURE_BITS) | 1
        columns.append(np.where(np.arange(used - n + 1)[None, :] + n <= length[:, None], f, 0))
    for n in (2, 3, 4):  # affixes: the mark and one to three letters
        head = np.zeros(len(words), np.uint64)
        tail = np.zeros(len(words), np.uint64)
        for i in range(n):
            head = (head ^ chars[:, i]) * _MIX
            tail = (tail ^ chars[rows, np.maximum(length - 1 - i, 0)]) * _MIX
        columns += [(_number(head, 10 + n, FEATURE_BITS) | 1)[:, None], (_number(tail, 20 + n, FEATURE_BITS) | 1)[:, None]]
    return np.concatenate(columns, axis=1)


@dataclass
class Model:
    """The labels are the languages and, last, none of them."""

    langs: list[str]
    weights: np.ndarray  # [2**FEATURE_BITS, L + 1]
    lexicon: np.ndarray  # [2**LEXICON_BITS, L + 1] log shares
    lexicon_weights: np.ndarray  # [L + 1, L + 1]
    bias: np.ndarray  # [L + 1]
    start: np.ndarray  # [L + 1]
    transitions: np.ndarray  # [L + 1, L + 1]

    def emissions(self, words: list[str]) -> np.ndarray:
        parts = [np.zeros((0, len(self.bias)))]
        for some in _slices(words):
            by_gram = self.weights[gram_features(some)].sum(axis=1)
            parts.append(by_gram + self.lexicon[lexicon_buckets(some)] @ self.lexicon_weights + self.bias)
        return np.concatenate(parts)


def log_shares(counts: np.ndarray) -> np.ndarray:
    """Smoothed log share of each language in each bucket, 0 where nothing is known."""
    prior = counts.sum(axis=0) + 1.0
    scaled = counts / prior * prior.mean()  # languages count alike
    total = scaled.sum(axis=1, keepdims=True)
    share = (scaled + 0.5) / (total + 0.5 * counts.shape[1])
    return np.where(total > 0, np.log(share * counts.shape[1]), 0.0).astype(np.float32)


def forward_backward(e: np.ndarray, first: np.ndarray, start: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities [n, L] of concatenated sequences, with the scaled forward and backward vectors.

    ``first`` marks where sequences begin. The line of words is folded into about sqrt(n) rows that advance together:
    products of step matrices per row, then the rows' entry vectors, then the steps inside all rows at once.
    """
    n, k = e.shape
    psi = np.exp(e - e.max(axis=1, keepdims=True))
    t, s = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    psi = np.concatenate([psi, np.ones((rows * width - n, k))]).reshape(rows, width, k)
    cut = np.concatenate([first, np.ones(rows * width - n, bool)]).reshape(rows, width)
    product = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
    for i in range(width):
        c = cut[:, i]
        step = product @ t
        if c.any():
            step[c] = product[c].sum(axis=2, keepdims=True) * s
        step *= psi[:, i, None, :]
        product = step / step.max(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((rows, k)), np.empty((rows, k))
    a, b = np.ones(k) / k, np.ones(k) / k
    for r in range(rows):
        enter[r] = a
        a = a @ product[r]
        a /= a.sum()
    for r in range(rows - 1, -1, -1):
        leave[r] = b
        b = product[r] @ b
        b /= b.sum()
    alpha, beta = np.empty_like(psi), np.empty_like(psi)
    a = enter
    for i in range(width):
        c = cut[:, i]
        a = np.where(c[:, None], s, a @ t) * psi[:, i]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, i] = a
    b = leave
    for i in range(width - 1, -1, -1):
        beta[:, i] = b
        c = cut[:, i]
        b = np.where(c[:, None], 1.0, (b * psi[:, i]) @ t.T)
        b /= b.sum(axis=1, keepdims=True)
    alpha, beta = alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n]
    gamma = alpha * beta
    return gamma / gamma.sum(axis=1, keepdims=True), alpha, beta


def training_sequence(docs: list[tuple[list[str], int]], seed: int = 7) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces of 8 to 60 words of all documents in a random order: words, labels, and where new sequences begin (every 8 pieces)."""
    rng, pieces = np.random.default_rng(seed), []
    for words, label in docs:
        at = 0
        while at < len(words):
            size = int(rng.integers(8, 61))
            pieces.append((words[at : at + size], label))
            at += size
    out: list[str] = []
    labels: list[int] = []
    first: list[bool] = []
    for i, j in enumerate(rng.permutation(len(pieces))):
        words, label = pieces[j]
        out += words
        labels += [label] * len(words)
        first += [i % 8 == 0] + [False] * (len(words) - 1)
    return out, np.array(labels), np.array(first, bool)


def made_words(docs: list[tuple[list[str], int]], none: int, seed: int = 11) -> list[tuple[list[str], int]]:
    """Documents of words of no language, about one for each language's share: letters in random order, and letters of random scripts.

    Scripts without blanks have words of two letters, which look alike in any order, so those that the languages use are left out.
    """
    rng = np.random.default_rng(seed)
    used = Counter(c for words, _ in docs for w in words[:200] for c in w)
    spaced = [c for c in used if not re.match(f"[{_UNSPACED}]", c)]
    letters, share = np.array(spaced), np.array([used[c] for c in spaced], float)
    lengths = np.array([len(w) for words, _ in docs for w in words[:200]])
    scripts = [(0x61, 26), (0xE0, 90), (0x3B1, 25), (0x430, 60), (0x5D0, 27), (0x627, 36), (0x905, 50), (0xE01, 46), (0x3041, 86), (0x4E00, 6000), (0xAC00, 9000)]
    scripts = [(a, n) for a, n in scripts if a == 0x61 or not any(a <= ord(c) < a + n and re.match(f"[{_UNSPACED}]", c) for c in used)]
    out = []
    for i in range(-(-len(docs) // max(none, 1)) if len(lengths) else 0):
        n = rng.choice(lengths, 150)
        if i % 3 or not len(letters):
            begin, many = scripts[int(rng.integers(len(scripts)))]
            chars = np.array([chr(c) for c in begin + rng.integers(0, many, int(n.sum()))])
        else:
            chars = rng.choice(letters, int(n.sum()), p=share / share.sum())
        ends = np.cumsum(n)
        words = [w for a, b in zip(ends - n, ends, strict=True) for w in tokens("".join(chars[a:b]))]
        out.append((words, none))
    return out


def fit(docs: list[tuple[list[str], int]], langs: list[str], counts: np.ndarray, rounds: int = 25, ridge: float = 1e-4) -> Model:
    """Maximises the regularised conditional likelihood by full-batch AdaGrad; ``counts`` has a column for each language."""
    k = len(langs) + 1
    words, y, first = training_sequence(docs + made_words(docs, k - 1))
    vocabulary = Vocabulary()
    ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    counts = np.concatenate([counts, np.zeros((len(counts), 1))], axis=1)
    model = Model(langs, np.zeros((1 << FEATURE_BITS, k)), log_shares(counts), np.eye(k) * 0.5, np.zeros(k), np.zeros(k), np.zeros((k, k)))
    if not len(ids):
        return model
    f, b = gram_features(list(vocabulary)).astype(np.int32), lexicon_buckets(list(vocabulary))
    lex, n = model.lexicon[b].astype(float), len(ids)
    inner = ~first[1:]
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:-1][inner], y[1:][inner]), 1)
    # whole sequences, about BLOCK words at a time, so that memory doesn't follow the length of the sampled texts
    starts = np.append(np.flatnonzero(first), n)
    edges = [0]
    for at in starts[1:]:
        if at - edges[-1] >= BLOCK or at == n:
            edges.append(int(at))
    names = ("weights", "lexicon_weights", "bias", "start", "transitions")
    history = {x: np.full_like(getattr(model, x), 1e-8) for x in names}
    for _ in range(rounds):
        by_gram = np.concatenate([model.weights[f[i : i + 4_000]].sum(axis=1) for i in range(0, len(f), 4_000)])
        by_word = by_gram + lex @ model.lexicon_weights + model.bias
        error, pair, begun, t = np.zeros((len(vocabulary), k)), np.zeros((k, k)), np.zeros(k), np.exp(model.transitions)
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            e, here = by_word[ids[i:j]], first[i:j]
            gamma, alpha, beta = forward_backward(e, here, model.start, model.transitions)
            ahead = np.exp(e - e.max(axis=1, keepdims=True)) * beta
            at = np.flatnonzero(~here[1:])
            for some in np.array_split(at, max(1, len(at) // 20_000)):
                p = alpha[some][:, :, None] * t * ahead[some + 1][:, None, :]
                pair += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            gamma *= -1
            gamma[np.arange(j - i), y[i:j]] += 1
            begun += gamma[here].sum(axis=0)
            for label in range(k):
                error[:, label] += np.bincount(ids[i:j], gamma[:, label], len(vocabulary))
        weights = np.zeros_like(model.weights)
        for i in range(0, len(f), 4_000):
            some = f[i : i + 4_000]
            for label in range(k):
                weights[:, label] += np.bincount(some.ravel(), np.repeat(error[i : i + 4_000, label], some.shape[1]), len(weights))
        weights[0] = 0
        grads = {"weights": weights, "lexicon_weights": lex.T @ error, "bias": error.sum(axis=0), "start": begun, "transitions": seen - pair}
        for x in names:
            g = grads[x] / n - ridge * getattr(model, x) / 100
            history[x] += g * g
            setattr(model, x, getattr(model, x) + 0.3 * g / np.sqrt(history[x]))
    model.weights = model.weights.astype(np.float32)
    return model


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, fit_docs: int = 600) -> Model | None:
    """Learns from the rows of ``docs`` (doc_id, text, lang) that are not held out."""
    rows = docs.where((_fold(F.col("doc_id")) != 2) & F.col("lang").isNotNull()).select(F.struct(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"), F.coalesce(F.md5("text"), F.lit("")).alias("t")).alias("at"), "text", "lang")
    many = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # as many as there are languages
    if not many:
        return None
    names = sorted(many)
    number, size = {x: i for i, x in enumerate(names)}, len(names)
    most = {x: min(-(-fit_docs // size), -(-n // 2)) for x, n in many.items()}
    # a little more than is needed by a share of the hash values, so that no sort sees all rows
    edge = {x: min(int(min(1.0, (1.2 * most[x] + 40) / n) * 2**64) - 2**63, 2**63 - 1) for x, n in many.items()}
    of_lang = lambda values: F.create_map(*[F.lit(v) for x in names for v in (x, values[x])])[F.col("lang")]
    some = rows.where(F.col("at.h") <= of_lang(edge)).dropDuplicates(["at", "lang"]).collect()
    sample, last = [], {}
    for x in names:
        mine = sorted((r for r in some if r["lang"] == x), key=lambda r: (r["at"]["h"], r["at"]["t"]))[: most[x]]
        sample += mine
        last[x] = (mine[-1]["at"]["h"], mine[-1]["at"]["t"]) if len(mine) == most[x] else (edge[x], "~")
    beyond = F.col("at") > F.struct(of_lang({x: v[0] for x, v in last.items()}).alias("h"), of_lang({x: v[1] for x, v in last.items()}).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, buckets = np.zeros(size << LEXICON_BITS, np.int64), np.zeros(0, np.int64)
        for vocabulary, ids, lengths, labels in _chunks(batches, "lang"):
            buckets = np.concatenate([buckets, *map(lexicon_buckets, _slices(list(islice(vocabulary, len(buckets), None))))])
            y = np.repeat([number[x] for x in labels], lengths).astype(np.int64)
            total += np.bincount(buckets[ids] * size + y, minlength=len(total))
            if len(vocabulary) > KNOWN:
                vocabulary.clear()
                buckets = buckets[:0]
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    counts = np.zeros(size << LEXICON_BITS)
    cells = rows.where(beyond).select("text", "lang").mapInArrow(count, "cell long, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n"))  # at most languages * 2**LEXICON_BITS rows
    got = cells.toArrow()
    counts[got["cell"].to_numpy()] = got["n"].to_numpy()
    return fit([(tokens(r["text"]), number[r["lang"]]) for r in sample], names, counts.reshape(-1, size))


def _slices(words: list[str]) -> Iterator[list[str]]:
    for i in range(0, len(words), 20_000):
        yield words[i : i + 20_000]


def _chunks(batches: Iterator[pa.RecordBatch], extra: str, vocabulary: Vocabulary | None = None) -> Iterator[tuple[Vocabulary, np.ndarray, list[int], list]]:
    """(vocabulary, word numbers, words per document, the extra column) for about CHUNK characters at a time; the vocabulary may be cleared."""
    vocabulary = Vocabulary() if vocabulary is None else vocabulary
    ids, lengths, extras, chars = [], [], [], 0
    for batch in batches:
        for text, x in zip(batch["text"], batch[extra].to_pylist(), strict=True):
            text = text.as_py()
            words = tokens(text)
            if words and not has_letter(words):
                words = []
            ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
            lengths.append(len(words))
            extras.append(x)
            chars += len(text or "")
            if chars >= CHUNK:
                yield vocabulary, np.concatenate(ids), lengths, extras
                ids, lengths, extras, chars = [], [], [], 0
    if lengths:
        yield vocabulary, np.concatenate(ids), lengths, extras


def tag(docs: DataFrame, model: Model | None, segments: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score and support and, if asked for, segments: runs of words of one language as structs (first_word, n_words, lang).

    A segment of no learned language has a null lang. Columns of ``docs`` with the new names are replaced.
    """
    text_batches(docs.sparkSession)
    made = ["lang_pred", "score", "support", "segments"][: 3 + segments]
    docs = docs.drop("lang_pred", "score", "support", "segments")
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)  # of a size that FEATURE_BITS and LEXICON_BITS set
    run = T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("lang", T.StringType())])
    types = {"lang_pred": T.StringType(), "score": T.DoubleType(), "support": T.DoubleType(), "segments": T.ArrayType(run)}
    runs_type = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(**shared.value) if shared.value else None
        vocabulary, known = Vocabulary(), m.emissions([]) if m else None
        for texts in batches:
            out: dict[str, list] = {c: [] for c in made}
            for _, ids, lengths, _ in _chunks(iter([pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], names=["k", "text"])]), "k", vocabulary) if m else ():
                if len(ids):
                    known = np.concatenate([known, m.emissions(list(islice(vocabulary, len(known), None)))])  # each word is scored once
                    e = known[ids]
                    sizes = np.array(lengths)
                    ends = np.cumsum(sizes)
                    starts = (ends - sizes)[sizes > 0]
                    first = np.zeros(len(ids), bool)
                    first[starts] = True
                    gamma = forward_backward(e, first, m.start, m.transitions)[0]
                    means = np.add.reduceat(gamma, starts, axis=0) / sizes[sizes > 0][:, None]
                    best = iter(zip(means[:, :-1].argmax(axis=1), means[:, :-1].max(axis=1), 1 - means[:, -1], strict=True))
                for i, size in enumerate(lengths):
                    j, p, there = next(best) if size else (None, 0.0, 0.0)
                    out["lang_pred"].append(m.langs[j] if size else "und")
                    out["score"].append(min(float(p), 1.0))
                    out["support"].append(min(max(float(there), 0.0), 1.0))
                    if segments:
                        path = gamma[ends[i] - size : ends[i]].argmax(axis=1) if size else np.zeros(0, int)
                        at = np.flatnonzero(np.diff(path, prepend=-1))
                        out["segments"].append([{"first_word": int(a), "n_words": int(b - a), "lang": [*m.langs, None][path[a]]} for a, b in zip(at, [*at[1:], size], strict=True)] if size else [])
                if len(vocabulary) > KNOWN:
                    vocabulary.clear()
                    known = known[:0]
            if not m:
                n = len(texts)
                out = {"lang_pred": ["und"] * n, "score": [0.0] * n, "support": [0.0] * n, "segments": [[]] * n}
            yield pa.StructArray.from_arrays([pa.array(out[c], runs_type if c == "segments" else pa.float64() if c in ("score", "support") else pa.string()) for c in made], names=made)

    # only texts go to Python; "nondeterministic" keeps a later filter from running it twice
    udf = F.arrow_udf(label, T.StructType([T.StructField(c, types[c]) for c in made])).asNondeterministic()
    return docs.withColumn("__tag", udf("text")).select(*docs.columns, *[F.col(f"__tag.{c}").alias(c) for c in made])


def identify(docs: DataFrame, fit_docs: int = 600) -> DataFrame:
    """Learns from ``docs`` (doc_id, text, lang) and labels all of them."""
    return tag(docs, train(docs, fit_docs))


def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = tag(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", F.coalesce(_fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "support")

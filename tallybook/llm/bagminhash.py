"""Near-duplicate documents by BagMinHash: weighted-Jaccard signatures, bands, and exact verification.

A document is the multiset of its five-word shingles (lower-cased words; a shorter text is one shingle of all its words).
For every shingle, a Poisson process runs in the plane of time and weight, the same in all documents that hold it. The
weight axis is discretised to whole numbers and cut into [0, 1), [1, 2), [2, 4), [4, 8) and so on. Each of these is the root of
a hierarchy: a process gives its first point, whose bits tell the unit of weight where it lies, and then splits into two
processes of half the width and half the rate, which go on from that time; a unit wide process isn't split. A document with weight ``w``
sees the points below ``w`` and never enters a half that lies above. Each point falls into one of ``registers`` registers, and a register keeps its earliest
point, so two documents agree in a register with a probability that is their weighted Jaccard similarity. A
process stops once its time is past the latest register, so the work is near the number of shingles, not times registers.

Registers are cut into bands. Documents of one exact text are one vertex. In every bucket (a band's value) that holds
several vertices, the one that meets most others is the hub; the others are compared with it and linked to it if the
multisets' similarity reaches the threshold. What is not in its hub's component after that is compared with all of its
bucket in blocks of bounded size, of which only links that join components leave the task. So no link between different
texts of a bucket is lost, while a large group of near copies never makes all its pairs. Components are the classes.

With 32 bands of 6 registers a pair at similarity 0.8 is missed with a probability of 6e-5, at 0.85 with 5e-8.

Edge cases: null and blank texts are classes of their own; a text of fewer than five words equals only texts of the same
words; repeated rows are copies, of which the first (by doc_id, nulls first) stays, and of rows that tie in id and text one; very long texts
are taken whole; an empty table gives no rows; other columns are carried along by ``dedup``, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import keep, table, text_batches, text_key
from tallybook.llm.components import components

_WORD = re.compile(r"\w+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
CHUNK = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_bags(texts: list[str], hashes: dict[str, int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, shingle, weight) of all texts, sorted by document and shingle."""
    words = [_WORD.findall(t.lower()) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    h = np.fromiter((hashes[x] for w in words for x in w), np.uint64, int(lengths.sum()))
    doc = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(h)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(lengths, lengths) - place
    s = np.zeros(len(h), np.uint64)
    for i in range(n):
        follows = np.zeros(len(h), np.uint64)
        follows[: len(h) - i] = h[i:]
        s = np.where(left > i, mix(s ^ follows), s)
    whole = (left >= n) | (place == 0)
    doc, s = doc[whole], s[whole]
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], s[at], np.diff(np.append(at, len(s)))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """[n_docs, registers] identities of the winning points; documents without shingles keep zeros."""
    top = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)  # roots that begin below the weight
    item = np.repeat(np.arange(len(doc)), top)
    root = np.arange(len(item)) - np.repeat(np.cumsum(top) - top, top)
    # live processes: document, weight, where they begin, width (and rate), seed, time, number of points
    d, w = doc[item], weight[item]
    low, size = np.where(root == 0, 0, 1 << np.maximum(root - 1, 0)), 1 << np.maximum(root - 1, 0)
    seed = mix(shingle[item] ^ (root.astype(np.uint64) * _MIX[2]))
    time, count = np.zeros(len(item)), np.zeros(len(item), np.uint64)
    best = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, np.uint64)
    latest = np.full(n_docs, np.inf)

    def points(at: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
        """The next ``many`` points of the processes ``at`` go to their registers; returns the times and random bits of all."""
        number = count[at][:, None] + np.arange(1, many + 1, dtype=np.uint64)
        r = mix(seed[at][:, None] ^ (number * _MIX[0]))
        gap = -np.log1p(-(r >> np.uint64(11)).astype(float) * 2.0**-53) / size[at][:, None]
        t = time[at][:, None] + np.cumsum(gap, axis=1)
        r2 = mix(r ^ _MIX[1])
        unit = low[at][:, None] + (r2 >> np.uint64(33)).astype(np.int64) % size[at][:, None]
        register = d[at][:, None] * registers + ((r2 & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
        use = (unit < w[at][:, None]) & (t <= latest[d[at]][:, None])
        register, when, identity = register[use], t[use], r[use]
        np.minimum.at(best, register, when)
        won = when == best[register]
        winner[register[won]] = identity[won]
        return t, r

    while len(d):
        many = int(np.clip(30_000 // len(d), 1, 64))
        wide = np.flatnonzero(size > 1)
        units = np.flatnonzero(size == 1)
        t, _ = points(units, many)
        time[units], count[units] = t[:, -1], count[units] + np.uint64(many)
        if len(wide):
            t = points(wide, 1)[0][:, 0]
            half = size[wide] >> 1
            upper = np.flatnonzero(low[wide] + half < w[wide])
            halves = [(wide, low[wide], half, mix(seed[wide] ^ _MIX[1]), t), (wide[upper], (low[wide] + half)[upper], half[upper], mix(seed[wide] ^ _MIX[2])[upper], t[upper])]
            d, w = (np.concatenate([x[units], *[x[h[0]] for h in halves]]) for x in (d, w))
            low, size, seed, time = (np.concatenate([x[units], *[h[k] for h in halves]]) for k, x in ((1, low), (2, size), (3, seed), (4, time)))
            count = np.concatenate([count[units], np.zeros(len(d) - len(units), np.uint64)])
        if many > 1 or len(d) > n_docs:
            latest = best.reshape(n_docs, registers).max(axis=1)
        stay = np.flatnonzero(time <= latest[d])
        d, w, low, size, seed, time, count = (x[stay] for x in (d, w, low, size, seed, time, count))
    return winner.reshape(n_docs, registers)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about CHUNK characters at a time."""
    start, texts, chars = 0, [], 0
    for i, t in enumerate(batch["text"]):
        texts.append(t.as_py() or "")
        chars += len(texts[-1])
        if chars >= CHUNK:
            yield start, texts
            start, texts, chars = i + 1, [], 0
    if texts:
        yield start, texts


def sign(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key (of the text; null for none) and bands: one hash per band (null for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            out: list[pa.Array] = []
            for _, texts in _chunks(batch):
                doc, s, w = shingle_bags(texts, hashes, shingle)
                sig = signatures(doc, s, w, len(texts), bands * rows).reshape(len(texts), bands, rows)
                h = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _MIX[1], (len(texts), bands))
                for i in range(rows):
                    h = mix(h ^ sig[:, :, i])
                some = np.zeros(len(texts), bool)
                some[doc] = True
                offsets = pa.array([None if not x else i * bands for i, x in enumerate(some)] + [len(texts) * bands], pa.int32())
                out.append(pa.ListArray.from_arrays(offsets, pa.array(h.reshape(-1).view(np.int64))))
                if len(hashes) > 300_000:
                    hashes.clear()
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))], names=["doc_id", "key", "bands"])

    text_batches(docs.sparkSession)
    keyed = docs.select("doc_id", "text", F.when(F.col("text").rlike(r"\S"), text_key("text")).alias("key"))
    return keyed.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, bands array<long>")


def profiles(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """v, shingles and weights of the texts in ``needed`` (v, doc_id, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for start, texts in _chunks(batch):
                doc, s, w = shingle_bags(texts, hashes, shingle)
                offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch["v"].slice(start, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(s.view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(w.astype(np.int32)))], names=["v", "shingles", "weights"]
                )
                if len(hashes) > 300_000:
                    hashes.clear()

    texts = docs.select(F.col("doc_id").alias("__d"), "text", text_key("text").alias("__k"))
    found = texts.join(needed, (F.col("__k") == F.col("key")) & F.col("__d").eqNullSafe(F.col("doc_id"))).select("v", "text")
    return found.mapInArrow(run, "v long, shingles array<long>, weights array<int>").dropDuplicates(["v"])


@F.pandas_udf(T.DoubleType())
def bag_similarity(a: pd.Series, aw: pd.Series, b: pd.Series, bw: pd.Series) -> pd.Series:
    """Weighted Jaccard similarity of bags given by distinct shingles and weights."""
    out = np.zeros(len(a))
    for i, (x, xw, y, yw) in enumerate(zip(a, aw, b, bw, strict=True)):
        _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        both = np.minimum(np.asarray(xw)[p], np.asarray(yw)[q]).sum()
        out[i] = both / max(np.sum(xw) + np.sum(yw) - both, 1)
    return pd.Series(out)


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    one = bags.select(F.col("v").alias("va"), F.col("shingles").alias("sa"), F.col("weights").alias("wa"))
    two = bags.select(F.col("v").alias("vb"), F.col("shingles").alias("sb"), F.col("weights").alias("wb"))
    both = pairs.join(one, F.col("a") == F.col("va")).join(two, F.col("b") == F.col("vb"))
    return both.select("a", "b", bag_similarity("sa", "wa", "sb", "wb").alias("similarity")).where(F.col("similarity") >= threshold)


def overlaps(offsets: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_left: int, width: int = 2048) -> np.ndarray:
    """Weighted overlaps [n_left, n] of the first ``n_left`` bags with all, by products of 0/1 matrices; bag i is ``offsets[i]`` to ``offsets[i + 1]``."""
    n = len(offsets) - 1
    member = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    _, column, many = np.unique(shingle, return_inverse=True, return_counts=True)
    both = np.zeros((n_left, n), np.float32)
    level = 1
    while True:  # min(x, y) is the number of levels that both reach
        use = np.flatnonzero((weight >= level) & (many[column] > 1))
        if not len(use):
            return both
        _, dense = np.unique(column[use], return_inverse=True)
        by = np.argsort(dense, kind="stable")
        edges = np.searchsorted(dense[by], np.arange(0, dense.max() + width + 1, width))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = use[by[a:b]]
            there = np.zeros((n, width), np.float32)
            there[member[part], dense[by[a:b]] % width] = 1
            both += there[:n_left] @ there.T
        level += 1


def _compared(at: DataFrame, labels: DataFrame, bags: DataFrame, threshold: float, block: int = 100) -> DataFrame:
    """Links (a, b) that tie the components within each bucket of ``at`` (bucket, v, hub): members that aren't in the hub's component meet all others.

    Buckets are cut into blocks of about ``block`` members and each pair of blocks is one small group; only links that
    join two components of the group leave it.
    """
    at = at.join(labels, "v", "left").select("bucket", "v", "hub", F.coalesce("component", "v").alias("component"))
    own = labels.select(F.col("v").alias("__hub"), F.col("component").alias("hub_component"))
    at = at.join(own, F.col("hub") == F.col("__hub"), "left").select("bucket", "v", "component", (F.col("component") != F.coalesce("hub_component", "hub")).alias("apart"))
    at = keep(at, "bag-at")
    counts = at.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("apart").alias("n_apart")).where("n_apart > 0 and n > 2")
    counts = keep(counts.select(F.col("bucket").alias("__bucket"), F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("n_apart") / block).cast("int").alias("blocks_apart")), "bag-counts")
    at = at.join(counts, F.col("bucket") == F.col("__bucket")).drop("__bucket")
    own_block = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = at.where("apart").select("bucket", "v", "component", own_block("blocks_apart").alias("i"), every("blocks").alias("j"), F.lit(True).alias("left"))
    right = at.select("bucket", "v", "component", every("blocks_apart").alias("i"), own_block("blocks").alias("j"), F.lit(False).alias("left"))
    profiles_of = bags.select(F.col("v").alias("__v"), "shingles", "weights")
    sides = left.unionAll(right).join(profiles_of, F.col("v") == F.col("__v")).drop("__v")

    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [("left", "descending"), ("v", "ascending")])).combine_chunks()
        n_left, v, label = pc.sum(group["left"]).as_py(), group["v"].to_numpy(), group["component"].to_numpy().copy()
        out: list[tuple[int, int]] = []
        if n_left and not (label == label[0]).all():
            bags_, weights = (group[c].combine_chunks() for c in ("shingles", "weights"))
            bags_ = bags_.chunk(0) if isinstance(bags_, pa.ChunkedArray) else bags_
            weights = weights.chunk(0) if isinstance(weights, pa.ChunkedArray) else weights
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(bags_).to_numpy(zero_copy_only=False))])
            weight = weights.flatten().to_numpy()
            both = overlaps(offsets, bags_.flatten().to_numpy(), weight, n_left)
            size = np.add.reduceat(weight, offsets[:-1]).astype(np.float64)
            near = both >= threshold * (size[:n_left, None] + size[None, :] - both) - 1e-6
            for i in range(n_left):
                for j in np.flatnonzero(near[i]):
                    if label[i] != label[j]:
                        out.append((min(v[i], v[j]), max(v[i], v[j])))
                        label[label == label[j]] = label[i]
        return pa.table([pa.array([int(x[k]) for x in out], pa.int64()) for k in (0, 1)], schema=links)

    return sides.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _grouped(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, bands: int = 32, rows: int = 6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, key), distinct texts (key, component), and one row per component: the class_id and class_key that stay."""
    signed = keep(sign(docs, shingle, bands, rows), "bag-signed")
    texts = signed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("no_id"), F.first("bands").alias("bands"))
    texts = texts.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))
    texts = keep(texts.select("key", "doc_id", "bands", F.monotonically_increasing_id().alias("v")), "bag-texts")
    members = texts.select("v", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(F.col("bucket").alias("__bucket"))
    members = keep(members.join(keep(shared, "bag-shared"), F.col("bucket") == F.col("__bucket")).select("bucket", "v"), "bag-members")
    needed = texts.join(members.select(F.col("v").alias("__v")).distinct(), F.col("v") == F.col("__v")).select("v", "doc_id", "key")
    bags = keep(profiles(docs, needed, shingle), "bag-profiles")
    # the member whose buckets are largest is the likeliest centre of a bucket's group
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).withColumnRenamed("bucket", "__bucket")
    central = members.join(sizes, F.col("bucket") == F.col("__bucket")).groupBy(F.col("v").alias("__v")).agg(F.sum("n").alias("met"))
    ranked = keep(members.join(central, F.col("v") == F.col("__v")).select("bucket", "v", "met"), "bag-ranked")
    hubs = keep(ranked.groupBy(F.col("bucket").alias("__bucket")).agg(F.max(F.struct("met", "v")).alias("top")).select("__bucket", F.col("top.v").alias("hub")), "bag-hubs")
    at = members.join(hubs, F.col("bucket") == F.col("__bucket")).drop("__bucket")
    pairs = keep(at.where("v <> hub").select(F.least("hub", "v").alias("a"), F.greatest("hub", "v").alias("b")).distinct(), "bag-pairs")
    links = keep(_verified(pairs, bags, threshold).select("a", "b"), "bag-links")
    rest = keep(_compared(at, components(links), bags, threshold), "bag-links")
    labels = components(links.unionAll(rest))
    named = texts.select("key", "doc_id", "v")
    named = named.join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "v", "key")).alias("first"))
    first = keep(first.select(F.col("component").alias("__c"), F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key")), "bag-first")
    return signed.select("doc_id", "key"), named.select("key", "component"), first


def classes(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, key (of the text), class_id (the class's smallest doc_id), class_key.

    A row with a null key is a class of its own. Rows of one class share class_key, the key of the text that stays.
    """
    signed, named, first = _grouped(docs, **options)
    named = keep(named.join(first, F.col("component") == F.col("__c")).select(F.col("key").alias("__key"), "class_id", "class_key"), "bag-named")
    out = signed.join(named, F.col("key") == F.col("__key"), "left")
    return out.select("doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "class_key")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but the first document of each class."""
    stay = _grouped(docs.select("doc_id", "text"), **options)[2].select(F.col("class_id").alias("__d"), F.col("class_key").alias("__k"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own"), F.col("doc_id").alias("__doc"), F.when(F.col("text").rlike(r"\S"), text_key("text")).alias("__key"))
    once = keyed.join(stay, (F.col("__key") == F.col("__k")) & F.col("__doc").eqNullSafe(F.col("__d"))).dropDuplicates(["__doc", "__key"])
    return once.select("__own").unionByName(keyed.where(F.col("__key").isNull()).select("__own")).select("__own.*")


def op3_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.col("key").isNull() | ((F.col("key") == F.col("class_key")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    return out.select("doc_id", "class_id", kept.alias("kept"))

"""Supplier names: one key per spelling by rules, then greedy clustering by similarity with a review queue."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.graph import settled
from tallybook.vocabulary import ABBREVIATIONS, AUTO_MERGE, LEGAL_FORMS, LONG_LEGAL_FORMS, REVIEW, TRADE_WORDS


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by one bit vector per row."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """200 times the common subsequence over both lengths; two empty strings are equal."""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def name_score(a: str, b: str) -> float:
    return max(ratio(a, b), ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


def _initials(words: list[str]) -> list[str]:
    """Runs of single letters become one word."""
    marked = re.sub(r"(?<!\S)([a-z])(?: (?=[a-z](?: |$)))", r"\1", " ".join(words))
    return marked.split()


def _glued(word: str) -> list[str]:
    """Cut before what looks most like a trade word, if it is close enough to one."""
    cuts = [i for i in range(3, len(word) - 3) if word[i:] not in ("son", "sons")] if len(word) >= 8 else []
    scores = [max(ratio(word[i:], t) for t in TRADE_WORDS if len(t) >= 4) for i in cuts]
    if scores and max(scores) >= 85:
        at = cuts[int(np.argmax(scores))]
        return [word[:at], word[at:]]
    return [word]


def supplier_key(folded: str) -> str:
    """The key of an ASCII-folded name: expanded, without "and" and legal forms."""
    text = folded.casefold().replace("&", " and ").replace("'", "")
    words = _initials(re.findall(r"[a-z0-9]+", text))
    words = [p for w in words for p in _glued(ABBREVIATIONS.get(w, w))]
    legal = lambda w: w in LEGAL_FORMS or (len(w) >= 5 and max(ratio(w, x) for x in LONG_LEGAL_FORMS) >= 85)
    return " ".join(w for w in words if w != "and" and not legal(w))


def _trade(word: str, last: bool) -> bool:
    for t in TRADE_WORDS:
        shortened = len(word) >= 3 and word[0] == t[0] and common_length(word, t) == len(word)
        cut_off = last and len(word) >= 2 and t.startswith(word)
        if word == t or shortened or cut_off or (len(word) >= 5 and ratio(word, t) >= 80):
            return True
    return False


def identity(key: str) -> str:
    """The key's words that aren't trade words; all of them if none is left."""
    words = key.split()
    return " ".join(w for i, w in enumerate(words) if not _trade(w, i == len(words) - 1)) or key


def similarity(a: str, b: str, identity_a: str | None = None, identity_b: str | None = None) -> float:
    a_id, b_id = identity_a or identity(a), identity_b or identity(b)
    return min(name_score(a, b), name_score(a_id, b_id))


@F.pandas_udf(T.StructType([T.StructField("match_key", T.StringType()), T.StructField("identity", T.StringType())]))
def keys_of(names: pd.Series) -> pd.DataFrame:
    folded = names.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
    keys = [supplier_key(x) for x in folded]
    return pd.DataFrame({"match_key": keys, "identity": [identity(k or x.lower()) for k, x in zip(keys, names, strict=True)]})


keys_of = keys_of.asNondeterministic()  # costly: not to be moved below a grouping or written out twice


@F.pandas_udf(T.DoubleType())
def scores(a: pd.Series, a_id: pd.Series, b: pd.Series, b_id: pd.Series) -> pd.Series:
    return pd.Series([similarity(*x) for x in zip(a, b, a_id, b_id, strict=True)], dtype=float)


scores = scores.asNondeterministic()  # a filter on it stays above the exchange that spreads the pairs


def _tokens(text: str) -> Column:
    """The characters of a text that isn't empty, each with the number of its occurrence: shared tokens are the shared multiset."""
    times = lambda c: F.length(text) - F.length(F.replace(F.col(text), c, F.lit("")))
    return F.flatten(F.transform(F.array_distinct(F.split(text, "")), lambda c: F.transform(F.sequence(F.lit(1), times(c)), lambda i: F.concat(c, i.cast("string")))))


#: Names of two lengths are looked up by their subsequences if there are at most so many of the length that both must share.
SUBSEQUENCES = 1000


def _needed(l: int, m: int, review: float) -> int:
    """Letters that names of lengths ``l`` and ``m`` must share, in order, to score ``review``."""
    return math.ceil((l + m) * review / 200 - 1e-9)


def _few(l: int, m: int, review: float) -> bool:
    n = _needed(l, m, review)
    return n <= min(l, m) and math.comb(l, n) + math.comb(m, n) <= SUBSEQUENCES


def _by_subsequence(keys: DataFrame, lengths: list[int], review: float) -> DataFrame:
    """a, a_id, b, b_id: the pairs whose identifying parts, in either order of the words, have a common subsequence long enough for ``review``.

    The planner takes the subsequences to be as few bytes as the keys, of which each has dozens: without a hint it would broadcast them.
    """
    sizes = {l: sorted({_needed(l, m, review) for m in lengths if _few(l, m, review)}) for l in lengths}

    def subsequences(batches):
        for pdf in batches:
            rows = []
            for key, name in zip(pdf["match_key"], pdf["identity"], strict=True):
                for form in {name, " ".join(sorted(name.split()))}:
                    rows += [(key, name, len(form), part) for n in sizes.get(len(form), []) for part in {"".join(x) for x in combinations(form, n)}]
            yield pd.DataFrame(rows, columns=["match_key", "identity", "l", "part"])

    spread = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a stated number isn't merged: few bytes are much work here
    parts = keys.repartition(spread, "match_key").mapInPandas(subsequences, "match_key string, identity string, l int, part string")
    parts = parts.select("match_key", "identity", "l", F.length("part").alias("n"), F.xxhash64("part").alias("part")).repartition(spread, "part", "n")  # a clash is one more candidate
    other = parts.select(*[F.col(c).alias(f"b_{c}") for c in parts.columns])
    needed = F.ceil((F.col("l") + F.col("b_l")) * F.lit(review / 200) - F.lit(1e-9))
    pairs = parts.hint("merge").join(other.hint("merge"), (F.col("part") == F.col("b_part")) & (F.col("n") == F.col("b_n")) & (F.col("match_key") < F.col("b_match_key"))).where(F.col("n") == needed)
    return pairs.select(F.col("match_key").alias("a"), F.col("identity").alias("a_id"), F.col("b_match_key").alias("b"), F.col("b_identity").alias("b_id"))


def _by_tokens(keys: DataFrame, lengths: list[int], review: float) -> DataFrame:
    """a, a_id, b, b_id: the pairs of the other lengths that share enough letters.

    Two keys with that many (character, occurrence) tokens in common share one of the first ``l - needed + 1`` and ``m - needed + 1`` in one order of
    all tokens, rare ones first: keys are joined on both lengths and these (hinted, as the planner doesn't see how many rows a key becomes).
    """
    needed = lambda l, m: F.ceil((l + m) * F.lit(review / 200) - F.lit(1e-9)).cast("int")
    spelled = keys.select("match_key", "identity", _tokens("match_key").alias("whole"), F.explode(_tokens("identity")).alias("token"))
    often = spelled.groupBy(F.col("token").alias("__token")).agg(F.count("*").alias("n"))
    ranked = spelled.join(often, F.col("token") == F.col("__token")).groupBy("match_key", "identity", "whole").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    ranked = ranked.withColumn("tokens", F.col("tokens.token")).withColumn("l", F.size("tokens"))
    partners = {l: [m for m in lengths if _needed(l, m, review) <= min(l, m) and not _few(l, m, review)] for l in lengths}
    met = F.create_map(*[x for l, ms in partners.items() for x in (F.lit(l), F.array(*[F.lit(m) for m in ms]).cast("array<int>"))])
    ranked = ranked.withColumn("m", F.explode(F.try_element_at(met, F.col("l"))))
    blocks = ranked.withColumn("block", F.explode(F.slice("tokens", F.lit(1), F.col("l") - needed(F.col("l"), F.col("m")) + 1)))
    blocks = blocks.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block", "l", "m")
    other = blocks.select(*[F.col(c).alias(f"b_{c}") for c in blocks.columns])
    pairs = blocks.hint("merge").join(other.hint("merge"), (F.col("block") == F.col("b_block")) & (F.col("l") == F.col("b_m")) & (F.col("m") == F.col("b_l")) & (F.col("match_key") < F.col("b_match_key")))
    common = F.array_intersect("tokens", "b_tokens")
    pairs = pairs.where((F.element_at(common, 1) == F.col("block")) & (F.size(common) >= needed(F.col("l"), F.col("m"))))  # each pair once, at its first common token
    pairs = pairs.where(F.size(F.array_intersect("whole", "b_whole")) >= needed(F.size("whole"), F.size("b_whole")))
    return pairs.select(F.col("match_key").alias("a"), F.col("identity").alias("a_id"), F.col("b_match_key").alias("b"), F.col("b_identity").alias("b_id"))


def candidate_pairs(keys: DataFrame, review: float = REVIEW) -> DataFrame:
    """(a, b, score) with a < b of all keys scored ``review`` (above 0) or more.

    The score is the lower of the whole names' and the identifying parts', so both must be alike. A score of ``review`` between lengths l and m
    needs a common subsequence of ``review * (l + m) / 200`` letters in one order of the words or the other. Where the lengths leave few
    subsequences of that size, keys are joined on them, so candidates grow no faster than alike parts do; longer names are joined on rare
    letters. What is found is scored; no pair is lost.
    """
    keys = keys.where((F.length("identity") > 0) & (F.length("match_key") > 0)).select("match_key", "identity")
    forms = F.explode(F.array(F.length("identity"), F.length(F.trim(F.regexp_replace("identity", r"\s+", " ")))))
    lengths = sorted(r["l"] for r in keys.select(forms.alias("l")).distinct().collect())  # no more than the longest name has letters
    found = [_by_tokens(keys, lengths, review)] if any(_needed(l, m, review) <= min(l, m) and not _few(l, m, review) for l in lengths for m in lengths) else []
    if not found or any(_few(l, m, review) for l in lengths for m in lengths):  # also if there are no names at all
        found.append(_by_subsequence(keys, lengths, review))
    pairs = reduce(DataFrame.unionAll, found).groupBy("a", "b").agg(F.first("a_id").alias("a_id"), F.first("b_id").alias("b_id"))
    pairs = pairs.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return pairs.withColumn("score", scores("a", "a_id", "b", "b_id")).where(F.col("score") >= review).select("a", "b", "score")


def greedy(keys: list[tuple[str, int]], edges: Iterable[tuple[str, str, float]], auto: float = AUTO_MERGE) -> tuple[dict[str, tuple[str, float]], dict[str, tuple[str, float]]]:
    """(key -> its anchor and score, queued key -> nearest anchor and score).

    Keys come by falling row count, then by name. Each joins the best earlier anchor that scores ``auto`` or more, else it is
    an anchor itself and, if an edge leads to an earlier anchor, queued for review.
    """
    near: dict[str, list[tuple[str, float]]] = {}
    for a, b, score in edges:
        near.setdefault(a, []).append((b, score))
        near.setdefault(b, []).append((a, score))
    place: dict[str, int] = {}
    found, queue = {}, {}
    for key, _ in sorted(keys, key=lambda k: (-k[1], k[0])):
        best = max(((s, -place[o], o) for o, s in near.get(key, []) if o in place), default=None)
        if best and best[0] >= auto:
            found[key] = (best[2], best[0])
            continue
        place[key] = len(place)
        found[key] = (key, 100.0)
        if best:
            queue[key] = (best[2], best[0])
    return found, queue


def greedy_rounds(keys: DataFrame, edges: DataFrame, auto: float = AUTO_MERGE) -> DataFrame:
    """``greedy`` by joins: ``keys`` (match_key, n), ``edges`` (a, b, score) -> key, anchor, score, nearest, nearest_score.

    Only edges of ``auto`` or more say who is an anchor: a key is none once an earlier neighbour by such an edge is one, and is one once all of them
    are none. So the rounds are as many as the longest chain of names that merge, of falling counts, and none holds the other edges, which are joined to
    the anchors at the end. A round is written once; a task sees a key's own edges at most, combined before the shuffle.
    """
    order = lambda n, k: F.struct((-F.col(n)).alias("n"), F.col(k).alias("k"))
    place = keys.select(F.col("match_key").alias("__k"), order("n", "match_key").alias("at"))
    both = edges.select("a", "b", "score").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    both = both.join(place.withColumnRenamed("at", "at_a"), F.col("a") == F.col("__k")).drop("__k").join(place.withColumnRenamed("at", "at_b"), F.col("b") == F.col("__k")).drop("__k")
    earlier = settled(both.where(F.col("at_b") < F.col("at_a")).select(F.col("a").alias("key"), "b", "at_b", "score"))
    left = earlier.where(F.col("score") >= auto).select("key", "b", F.lit(None).cast("boolean").alias("anchors"))
    fresh = settled(keys.select(F.col("match_key").alias("key")).join(left.select("key"), "key", "left_anti").withColumn("leads", F.lit(True)))
    rounds = [fresh]
    while not left.isEmpty():
        # edges learn what the last round has decided of their earlier key; what was decided before stands in them already
        known = fresh.select(F.col("key").alias("__b"), F.col("leads").alias("__now"))
        left = settled(left.join(known, F.col("b") == F.col("__b"), "left").withColumn("anchors", F.coalesce("anchors", "__now")).drop("__b", "__now"))
        asked = left.groupBy("key").agg(F.count_if(F.col("anchors").isNull()).alias("open"), F.count_if("anchors").alias("led"))
        fresh = settled(asked.where("led > 0 OR open = 0").select("key", (F.col("led") == 0).alias("leads")))
        rounds.append(fresh)
        left = left.join(fresh.select("key"), "key", "left_anti")
    anchors = reduce(DataFrame.unionAll, rounds).where("leads").select(F.col("key").alias("__b"))
    best = earlier.join(anchors, F.col("b") == F.col("__b")).groupBy(F.col("key").alias("__key")).agg(F.min(F.struct((-F.col("score")).alias("s"), "at_b", "b")).alias("best"))
    score = -F.col("best.s")
    joins = score >= auto
    out = keys.select(F.col("match_key").alias("key")).join(best, F.col("key") == F.col("__key"), "left")
    return out.select("key", F.when(joins, F.col("best.b")).otherwise(F.col("key")).alias("anchor"), F.when(joins, score).otherwise(100.0).alias("score"), F.when(~joins, F.col("best.b")).alias("nearest"), F.when(~joins, score).alias("nearest_score"))


def match_suppliers(counts: DataFrame, auto: float = AUTO_MERGE, review: float = REVIEW) -> DataFrame:
    """``counts`` (alias, row_count) -> alias, match_key, anchor, canonical, method, score, nearest, nearest_score, row_count.

    The canonical spelling is the most frequent of the cluster. A name without any key (a legal form alone) is its own cluster by its spelling.
    """
    dealt = counts.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work
    keyed = dealt.withColumn("k", keys_of("alias")).select("alias", "row_count", F.when(F.col("k.match_key") == "", F.lower("alias")).otherwise(F.col("k.match_key")).alias("match_key"), "k.identity")
    keyed = settled(keyed)
    keys = settled(keyed.groupBy("match_key").agg(F.first("identity").alias("identity"), F.sum("row_count").alias("n")))
    clusters = greedy_rounds(keys, settled(candidate_pairs(keys, review)), auto)
    out = keyed.join(clusters, F.col("match_key") == F.col("key"))
    canonical = out.groupBy(F.col("anchor").alias("__a")).agg(F.min(F.struct((-F.col("row_count")).alias("n"), "alias", "match_key")).alias("first"))
    out = out.join(canonical, F.col("anchor") == F.col("__a")).withColumn("canonical", F.col("first.alias"))
    method = F.when(F.col("alias") == F.col("canonical"), "exact").when(F.col("match_key") == F.col("first.match_key"), "normalized").otherwise("fuzzy")
    return out.select("alias", "match_key", "anchor", "canonical", method.alias("method"), F.round("score", 2).alias("score"), "nearest", F.round("nearest_score", 2).alias("nearest_score"), "row_count")


def alias_tables(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The spellings with their supplier's key, and the suppliers, of ``match_suppliers``."""
    aliases = matches.select("alias", F.col("anchor").alias("match_key"), F.col("method").alias("match_method"), F.col("score").cast("decimal(5,2)").alias("score"), "row_count")
    return aliases, matches.groupBy(F.col("anchor").alias("match_key")).agg(F.first("canonical").alias("canonical_name"))


def pair_scores(rows: DataFrame, predicted: str, truth: str) -> DataFrame:
    """correct, predicted and true pairs with precision, recall and f1 of a clustering."""

    def pairs(*by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("p"))

    both = pairs(predicted, truth).withColumnRenamed("p", "correct").crossJoin(pairs(predicted).withColumnRenamed("p", "predicted")).crossJoin(pairs(truth).withColumnRenamed("p", "true_pairs"))
    part = lambda of: F.when(F.col(of) == 0, 1.0).otherwise(F.col("correct") / F.col(of))
    out = both.withColumns({"precision": part("predicted"), "recall": part("true_pairs")})
    total = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(total == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / total))

"""Choosing the match thresholds: many seeded universes of spellings, scored at every threshold on the cluster."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.matching import greedy, identity, similarity, supplier_key
from tallybook.plans.synthetic import alias_universe

SEEDS = (101, 202, 303, 404, 505)
FLOOR, PRECISION, BAND = 50, 0.99, 5


def sweep(spark: SparkSession, seeds=SEEDS, thresholds=range(70, 101)) -> DataFrame:
    """threshold, correct, predicted, true_pairs, precision, recall over all universes. Each universe is one group; its pairs are scored once."""

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        names = alias_universe(int(pdf["seed"].iloc[0]))
        keys = {s: supplier_key(s) for s, _, _ in names}
        rows: dict[str, int] = {}
        for s, _, n in names:
            rows[keys[s]] = rows.get(keys[s], 0) + n
        ids = {k: identity(k) for k in rows}
        listed = sorted(rows)
        edges = [(a, b, similarity(a, b, ids[a], ids[b])) for i, b in enumerate(listed) for a in listed[:i]]
        edges = [e for e in edges if e[2] >= FLOOR]
        pairs = lambda groups: int(sum(n * (n - 1) // 2 for n in groups.value_counts()))
        out = []
        for t in pdf["threshold"]:
            found, _ = greedy(list(rows.items()), edges, float(t))
            got = pd.DataFrame([(found[keys[s]][0], true) for s, true, _ in names], columns=["cluster", "true"])
            out.append((int(t), pairs(got["cluster"] + "|" + got["true"]), pairs(got["cluster"]), pairs(got["true"])))
        return pd.DataFrame(out, columns=["threshold", "correct", "predicted", "true_pairs"])

    grid = spark.createDataFrame([(s,) for s in seeds], "seed int").select("seed", F.explode(F.lit(list(thresholds))).alias("threshold"))
    each = grid.groupBy("seed").applyInPandas(score, "threshold int, correct long, predicted long, true_pairs long")
    total = each.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("correct", "predicted", "true_pairs")])
    part = lambda c: F.when(F.col(c) == 0, 1.0).otherwise(F.col("correct") / F.col(c))
    return total.withColumns({"precision": part("predicted"), "recall": part("true_pairs")}).orderBy("threshold")


def calibrate(spark: SparkSession, seeds=SEEDS) -> tuple[int, int]:
    """(auto, review): the threshold of most recall at a precision of 0.99 or more (the highest of equals), and the lowest of the
    five-point bands below it in which, one after the other, at least half of the newly merged pairs are right."""
    table = {r["threshold"]: r for r in sweep(spark, seeds, range(FLOOR, 101)).collect()}
    auto = max((t for t in table if t >= 70 and table[t]["precision"] >= PRECISION), key=lambda t: (table[t]["recall"], t))
    review = auto
    while review - BAND >= FLOOR:
        new, right = (table[review - BAND][c] - table[review][c] for c in ("predicted", "correct"))
        if new and right / new < 0.5:
            break
        review -= BAND
    return auto, review

"""License scan by diagonal voting over word k-grams.

1. Words: A-Z lower-cased, then maximal runs of digits, a-z and non-ASCII characters.
2. The hashes of all rolling k-grams of all documents are joined to the templates' k-gram positions (broadcast only while the
   templates are at most SMALL characters long); the join also compares the words, so no hash collision survives. Only hits, and one narrow row per
   document that carries its counts, go on.
3. Votes are counted by (document, template, diagonal), where the diagonal is document position minus template position.
4. Neighbouring diagonals (at most ``gap`` apart: words put in or left out) are merged into one span.
5. A span is verified: its distinct template k-grams must cover ``min_cover`` of the template, in at most ``max_stretch`` times
   its length. Its score is that cover.

Base phrases are counted beside this: places where a phrase's words stand consecutively.

All of it is DataFrame expressions. Templates are a bounded parameter; the largest thing that is shuffled is one row per
hit and one narrow row per document, never a text.

Edge cases: null text is an empty text (no words, no labels, score 0); very long texts are scanned whole; repeated rows
are documents of their own (rows are told apart by position, not by doc_id); a null doc_id is kept; an empty table gives
no rows; other columns are carried along, whatever their names, but for those that are named like a result.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import table

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Short notices as they are commonly written.
TEMPLATES = {
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced without permission.",
}


SMALL = 1_000_000
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased, then cut at all ASCII characters but digits and a-z."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), GAPS), "")


def _grams(tokens: Column, k: int) -> Column:
    """One struct of ``k`` words per word: it and those after it, null beyond the end."""
    return F.arrays_zip(*[(F.slice(tokens, j + 1, F.size(tokens)) if j else tokens).alias(f"w{j}") for j in range(k)])


def _gram_words(k: int) -> list[Column]:
    return [F.col(f"g.w{j}").alias(f"w{j}") for j in range(k)]


def template_grams(spark: SparkSession, templates: Mapping[str, str] = TEMPLATES, k: int = 3) -> DataFrame:
    """hash, label, t_pos, n_grams and the words w0.. of each template's k-grams."""
    t = spark.createDataFrame(list(templates.items()), "label string, body string").withColumn("w", words(F.col("body")))
    t = t.select("label", (F.size("w") - k + 1).alias("n_grams"), F.posexplode(_grams(F.col("w"), k)).alias("t_pos", "g"))
    t = t.where(F.col("t_pos") < F.col("n_grams")).select("label", "n_grams", "t_pos", *[F.col(f"g.w{j}").alias(f"t{j}") for j in range(k)])
    return t.withColumn("t_hash", F.xxhash64(*[f"t{j}" for j in range(k)]))


def _phrase_columns(base: Mapping[str, str]) -> dict[str, Column]:
    """Places of each phrase in ``__flat``, where every word stands between its own two blanks."""
    flat, n_words = F.col("__flat"), F.col("n_words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in base.items():
        n, p = len(phrase.split()), "".join(f" {w} " for w in phrase.split())
        there = F.instr(flat, p) > 0
        blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
        counts.append(F.when(there, ((F.length(flat) - F.length(F.replace(flat, F.lit(p), F.lit("")))) / len(p)).cast("long")).otherwise(0))
        firsts.append(F.when(there, (blanks(F.substring_index(flat, p, 1)) / 2).cast("long")))
        lasts.append(F.when(there, (n_words - n - blanks(F.substring_index(flat, p, -1)) / 2).cast("long")))
        labels.append(F.when(there, F.lit(label)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return {"n_base": total.cast("long"), "first_word": F.least(*firsts, F.lit(None)), "last_word": F.greatest(*lasts, F.lit(None)), "__base": F.array_compact(F.array(*labels))}


def spans(docs: DataFrame, base: Mapping[str, str] = BASE, templates: Mapping[str, str] = TEMPLATES, k: int = 3, gap: int = 2, min_cover: float = 0.6, max_stretch: float = 1.5) -> DataFrame:
    """One row per document: its other columns but the text, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` are structs (label, start, length, cover) in words. Columns of ``docs`` with these names are replaced.
    A phrase must not end with the words it starts with (such places could overlap).
    """
    grams = template_grams(docs.sparkSession, templates, k)
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
    rest = [c for c in docs.columns if c != "text" and c not in made]
    d = docs.select(F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in rest]).alias("__rest"), words(F.col("text")).alias("__w"), F.monotonically_increasing_id().alias("__row"))
    some = F.arrays_overlap("__w", F.array(*[F.lit(max(p.split(), key=len)) for p in base]))  # else no phrase can stand there
    flat = F.when(some, F.concat(F.lit(" "), F.array_join("__w", "  "), F.lit(" "))).otherwise("")
    d = d.withColumns({"n_words": F.size("__w").cast("long"), "__flat": flat}).withColumns(_phrase_columns(base)).drop("__flat")
    info = F.struct("__rest", "n_words", "n_base", "first_word", "last_word", "__base").alias("__info")
    h = d.select("__row", info, F.posexplode_outer(_grams(F.col("__w"), k)).alias("pos", "g")).select("__row", "__info", "pos", *_gram_words(k))
    h = h.withColumn("hash", F.xxhash64(*[f"w{j}" for j in range(k)]))
    same = F.col("hash") == F.col("t_hash")
    for j in range(k):
        same = same & (F.col(f"w{j}") == F.col(f"t{j}"))
    grams = F.broadcast(grams) if sum(map(len, templates.values())) <= SMALL else grams
    h = h.join(grams, same, "left").where(F.col("label").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))  # a document's first row stays
    h = h.select("__row", "__info", "label", "n_grams", "pos", "t_pos", (F.col("pos") - F.col("t_pos")).alias("diag"))
    votes = h.groupBy("__row", "label", "n_grams", "diag").agg(F.first("__info").alias("__info"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("t_pos").alias("seen"))
    along = Window.partitionBy("__row", "label").orderBy("diag", "lo")
    votes = votes.withColumn("new", (F.col("diag") - F.lag("diag").over(along) > gap).cast("int"))
    votes = votes.withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(along))
    merged = votes.groupBy("__row", "label", "n_grams", "span").agg(
        F.first("__info").alias("__info"), F.min("lo").alias("start"), (F.max("hi") + k - F.min("lo")).alias("length"), F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("n_seen")
    )
    cover = F.col("n_seen") / F.col("n_grams")
    good = F.col("label").isNotNull() & (cover >= min_cover) & (F.col("length") <= max_stretch * (F.col("n_grams") + k - 1))
    span = F.when(good, F.struct(F.col("label"), F.col("start").cast("long"), F.col("length").cast("long"), cover.alias("cover")))
    out = merged.groupBy("__row").agg(F.first("__info").alias("__info"), F.sort_array(F.collect_list(span)).alias("spans"))
    base_labels = F.col("__info.__base")
    found = F.array_distinct(F.concat(base_labels, F.transform("spans", lambda s: s["label"])))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0))
    return out.select(
        *[F.col("__info.__rest").getField(c).alias(c) for c in rest], *[F.col(f"__info.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(found), ",").alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(best).alias("score"), "spans",
    )


def op1_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _values(rows: Mapping[str, str]) -> str:
    return ", ".join("('" + a.replace("'", "''") + "', '" + b.replace("'", "''") + "')" for a, b in rows.items())


_SQL_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH t0(label, body) AS (VALUES {_values(TEMPLATES)}),
t1 AS (SELECT label, {_SQL_WORDS.format("body")} AS w FROM t0),
t AS (SELECT label, len(w) - 2 AS n_grams, i AS t_pos, array_to_string(w[i + 1:i + 3], ' ') AS gram FROM t1, unnest(range(len(w) - 2)) AS u(i)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS.format("text")} AS w FROM documents),
g AS (SELECT r, i AS pos, array_to_string(w[i + 1:i + 3], ' ') AS gram FROM d, unnest(range(len(w) - 2)) AS u(i)),
h AS MATERIALIZED (SELECT r, label, n_grams, pos, t_pos, pos - t_pos AS diag FROM g JOIN t USING (gram)),
v AS (SELECT r, label, diag, CASE WHEN diag - lag(diag) OVER (PARTITION BY r, label ORDER BY diag) > 2 THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT r, label, diag FROM h)),
s AS (SELECT r, label, diag, sum(new) OVER (PARTITION BY r, label ORDER BY diag) AS span FROM v),
m AS (SELECT r, label, n_grams, span, count(DISTINCT t_pos)::DOUBLE / n_grams AS cover, max(pos) + 3 - min(pos) AS length FROM h JOIN s USING (r, label, diag) GROUP BY r, label, n_grams, span),
found AS (SELECT r, label, cover FROM m WHERE cover >= 0.6 AND length <= 1.5 * (n_grams + 2)),
b0(phrase, label) AS (VALUES {_values(BASE)}),
b1 AS (SELECT string_split(phrase, ' ') AS p, label FROM b0),
b AS (SELECT r, label, i AS pos FROM d, b1, unnest(range(len(w) - len(p) + 1)) AS u(i) WHERE w[i + 1] = p[1] AND w[i + 1:i + len(p)] = p),
bs AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r),
ls AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM b UNION ALL SELECT r, label FROM found) GROUP BY r),
cs AS (SELECT r, max(cover) AS cover FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
 coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs USING (r) LEFT JOIN ls USING (r) LEFT JOIN cs USING (r)
"""

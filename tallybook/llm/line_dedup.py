"""Substring dedup by line hashing.

Units are lines of at least ``min_line_words`` words and, inside lines that hold several, sentences of at least
``min_sentence_words`` words (so that a passage pasted into the middle of a line is found too). The query and the pipeline hash every line that isn't
blank, and sentences of at least four words: shorter ones inside running text repeat by chance. A unit is normalised
(lower-cased, white space collapsed) and hashed to 128 bits. Of all units with one digest the earliest stays: the one in
the smallest (doc_id, row), null ids first, and inside a document the one that starts first. All others are removed;
their offsets in the original text are returned.

Repeats inside a document are settled inside its task. Digests are then grouped with map-side combining, only those that
occur in several documents are written out, and the units meet them in a join whose hot keys Spark can split. The rows
of a document come together by its row number. No group of equal units is ever gathered.

Edge cases: null text stays null and has no units; empty and blank texts have none; repeated rows are documents of their
own, so that only the first keeps its units; very long texts are taken whole; an empty table gives no rows; other columns
are carried along, but for those that are named like a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table, text_batches

LINE_WORDS, SENTENCE_WORDS = 1, 4
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*[^\S\n]*")


def units_of(text: str, min_line_words: int, min_sentence_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of each unit; a line's end includes its line break."""
    at = 0
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        words = line.lower().split()
        if len(words) >= min_line_words:
            yield at, end, xxhash.xxh3_128_digest(" ".join(words))
            if len(words) > min_sentence_words:
                found = list(_SENTENCE.finditer(line))
                if len(found) > 1:
                    for m in found:
                        words = m[0].lower().split()
                        if len(words) >= min_sentence_words:
                            yield at + m.start(), at + m.end(), xxhash.xxh3_128_digest(" ".join(words))
        at = end


def drop_spans(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            out.append(text[at:start])
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def dedup_lines(docs: DataFrame, min_line_words: int = 5, min_sentence_words: int = 8) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``text`` cut, n_units, n_removed and ``removed`` (structs start, end in the original text, by start).

    Columns of ``docs`` with the new names are replaced.
    """
    text_batches(docs.sparkSession)
    docs = keep(docs.drop("n_units", "n_removed", "removed").withColumn("__row", F.monotonically_increasing_id()), "line-docs")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, starts, ends, digests, again = [], [], [], [], [], []
            for row, doc_id, text in zip(batch["__row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                seen: set[bytes] = set()
                for start, end, digest in units_of(text or "", min_line_words, min_sentence_words):
                    rows.append(row)
                    ids.append(doc_id)
                    starts.append(start)
                    ends.append(end)
                    digests.append(digest)
                    again.append(digest in seen)
                    seen.add(digest)
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype("i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, batch.schema.field("doc_id").type), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(again, pa.bool_())],
                names=["__unit_row", "doc_id", "start", "end", "h1", "h2", "again"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    units = keep(docs.select("__row", "doc_id", "text").mapInArrow(scan, f"__unit_row long, doc_id {id_type}, start int, end int, h1 long, h2 long, again boolean"), "line-units")
    fresh = units.where(~F.col("again"))
    shared = fresh.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "__unit_row")).alias("first")).where("n > 1")
    shared = keep(shared.select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("first.__unit_row").alias("first_row")), "line-shared")
    copies = fresh.join(shared, (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2"))).where(F.col("__unit_row") != F.col("first_row"))
    cut = copies.select("__unit_row", "start", "end").unionAll(units.where("again").select("__unit_row", "start", "end"))
    counts = units.groupBy("__unit_row").agg(F.count("*").alias("n_units"))
    cut = cut.groupBy("__unit_row").agg(F.collect_list(F.struct("start", "end")).alias("removed"))
    found = counts.join(cut, "__unit_row", "left")

    @F.pandas_udf("string")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else drop_spans(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans, strict=True)], dtype=object)

    out = docs.join(found, F.col("__row") == F.col("__unit_row"), "left").drop("__unit_row", "__row")
    out = out.withColumns({"n_units": F.coalesce("n_units", F.lit(0)), "text": F.when(F.col("removed").isNull(), F.col("text")).otherwise(apply("text", "removed"))})
    return out.withColumns({"removed": F.sort_array(F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")))}).withColumn("n_removed", F.size("removed"))


def op5_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``removed`` as text: start-end of each removed unit, by start."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), LINE_WORDS, SENTENCE_WORDS)
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), " ")
    return out.select("doc_id", F.col("n_units").cast("long").alias("n_units"), F.col("n_removed").cast("long").alias("n_removed"), spans.alias("removed"), "text")


#: What Python splits words at.
_BLANK = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
def _sql_words(of: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({of}), '[{_BLANK}]+'), lambda x: x <> '')"


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l0 AS (SELECT r, doc_id, length(text) AS n, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL),
l1 AS (SELECT r, doc_id, n, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM l0),
l2 AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, {_sql_words("line")} AS w FROM l1),
l3 AS (SELECT * FROM l2 WHERE len(w) >= {LINE_WORDS}),
p0 AS (SELECT r, doc_id, k, s, regexp_extract_all(line, '[.!?]*[^.!?]+[.!?]*[{_BLANK}]*') AS ps FROM l3 WHERE len(w) > {SENTENCE_WORDS}),
p1 AS (SELECT r, doc_id, k, s, unnest(ps) AS p, generate_subscripts(ps, 1) AS j FROM p0 WHERE len(ps) > 1),
p2 AS (SELECT r, doc_id, k, j, s + coalesce(sum(length(p)) OVER (PARTITION BY r, k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, p, regexp_replace(p, '^[.!?]*', '') AS q FROM p1),
u AS (SELECT r, doc_id, k, 0 AS j, s, least(s + length(line) + 1, n) AS e, array_to_string(w, ' ') AS x FROM l3
      UNION ALL SELECT r, doc_id, k, j, s + length(p) - length(q), s + length(p), array_to_string({_sql_words("q")}, ' ') FROM p2 WHERE len({_sql_words("q")}) >= {SENTENCE_WORDS}),
g AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id NULLS FIRST, r, k, j) > 1 AS again FROM u),
c AS (SELECT r, s, e, coalesce(max(e) OVER (PARTITION BY r ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM g WHERE again),
t AS (SELECT c.r, count(*) AS n_removed, string_agg(s::BIGINT || '-' || e::BIGINT, ' ' ORDER BY s, e) AS removed,
        string_agg(CASE WHEN s > gone THEN substring(text, gone::BIGINT + 1, (s - gone)::BIGINT) ELSE '' END, '' ORDER BY s, e) || any_value(substring(text, (SELECT max(e) FROM c x WHERE x.r = c.r)::BIGINT + 1)) AS text
      FROM c JOIN d ON d.r = c.r GROUP BY c.r)
SELECT d.doc_id, coalesce((SELECT count(*) FROM u WHERE u.r = d.r), 0)::BIGINT AS n_units, coalesce(t.n_removed, 0)::BIGINT AS n_removed, coalesce(t.removed, '') AS removed,
  CASE WHEN t.r IS NULL THEN d.text ELSE t.text END AS text
FROM d LEFT JOIN t ON t.r = d.r
"""

"""Mixing sources to target weights by a time-varying curriculum.

Targets: source ``i`` (by code point, null last) has the weight ``weights[i % len]``; ``demand`` times all words
are shared by weight, no source gets more than ``cap`` times its words, and what is cut goes to the others by weight.
That fixed point is one level ``x`` with ``target = min(cap * size, x * weight)``; a sort by ``cap * size / weight`` finds it.

Order: inside a source, documents lie in the order of a hash of their id, pass after pass. A pass over a document is
taken while its middle word lies before the target. Each source's share of the stream changes over the training time
``t`` in [0, 1] as ``1 + ramp * (1 - 2 t)``; its integral ``t + ramp * (t - t * t)`` is the demand up to ``t``, and solving
it for a pass's place among the source's words gives the pass's training position. Rows come back sorted by position.

Prefix sums need no group in one task: words are summed by (source, 12 bits of the hash) first, the sums are accumulated,
and only inside such a bucket does a window run over rows. Everything is DataFrame expressions.

Edge cases: null or empty text has size 0 and is never counted (``taken`` 0); a null source is a source of its own, last;
repeated rows are documents of their own; a null doc_id is hashed like the empty string; very long texts are counted whole; documents that agree
in id and size stand in either order; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table

BLANKS = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: How strongly a source leans to the start (over 0) or the end of training, by rank as the weights.
RAMPS = (-0.5, 0.5, 0.0)


def source_targets(sums: DataFrame, demand: float = 1.5, cap: float = 2.0, weights=WEIGHTS, ramps=RAMPS) -> DataFrame:
    """``sums`` (source, source_size) -> source, source_size, target, ramp. One row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sums.withColumn("i", F.row_number().over(order) - 1)
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (F.col("i") % len(xs) + 1).cast("int"))
    s = ranked.withColumns({"weight": pick(weights), "ramp": pick(ramps)})
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "i")
    every = Window.partitionBy()
    s = s.withColumns(
        {
            "before": F.coalesce(F.sum("source_size").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "weight_left": F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(every),
        }
    )
    level = (F.lit(demand) * F.col("total") - F.lit(cap) * F.col("before")) / F.col("weight_left")
    s = s.withColumn("level", F.when(level * F.col("weight") <= F.lit(cap) * F.col("source_size"), level))
    s = s.withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.struct(F.col("source_size") / F.col("weight"), F.col("i")))).over(every))
    target = F.least(F.lit(cap) * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), F.lit(cap) * F.col("source_size")))
    return s.select("source", "source_size", target.alias("target"), "ramp")


def place(docs: DataFrame, demand: float = 1.5, cap: float = 2.0, weights=WEIGHTS, ramps=RAMPS) -> DataFrame:
    """``mix`` before the range sort, with the hash that orders a source as ``__key``."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.withColumns(
        {
            "__source": F.coalesce("source", F.lit("")),
            "__none": F.col("source").isNull(),
            "size": F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), BLANKS), "")).cast("long"),
            "__key": key,
            "__bucket": F.conv(F.substring(key, 1, 3), 16, 10).cast("int"),
        }
    )
    by_bucket = keep(sized.groupBy("__source", "__none", "__bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    per_source = by_bucket.groupBy("__source", "__none").agg(F.sum("words").alias("source_size"))
    targets = source_targets(per_source.select(F.when(~F.col("__none"), F.col("__source")).alias("source"), "source_size"), demand, cap, weights, ramps)
    targets = targets.select(F.coalesce("source", F.lit("")).alias("__t"), F.col("source").isNull().alias("__tn"), "source_size", "target", F.col("ramp").alias("__ramp"))
    before = F.sum("words").over(Window.partitionBy("__source", "__none").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_bucket.select(F.col("__source").alias("__s"), F.col("__none").alias("__n"), F.col("__bucket").alias("__b"), F.coalesce(before, F.lit(0)).alias("__start"))
    starts = keep(starts.join(targets, (F.col("__s") == F.col("__t")) & (F.col("__n") == F.col("__tn"))).select("__s", "__n", "__b", "__start", "source_size", "target", "__ramp"), "mix-starts")
    rows = sized.drop("source_size", "target", "copies", "taken", "position", "positions")
    inside = Window.partitionBy("__source", "__none", "__bucket").orderBy("__key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # up to 4,096 rows a source: merged on the window's own partitioning, never broadcast
    rows = rows.join(starts.hint("merge"), (F.col("__source") == F.col("__s")) & (F.col("__none") == F.col("__n")) & (F.col("__bucket") == F.col("__b")), "left")
    middle = F.col("__start") + F.col("__inside") + F.col("size") / 2
    rows = rows.withColumn("__middle", middle)
    passes = int(-(-cap // 1))
    places = F.filter(F.array(*[F.col("__middle") + k * F.col("source_size") for k in range(passes)]), lambda x: x <= F.col("target"))
    a = F.col("__ramp")

    def position(x):
        y = F.least(x / F.greatest(F.col("target"), F.lit(1e-9)), F.lit(1.0))
        return F.when(a == 0, y).otherwise(((1 + a) - F.sqrt(F.greatest((1 + a) * (1 + a) - 4 * a * y, F.lit(0.0)))) / (2 * a))

    rows = rows.withColumn("__places", places).withColumns({"copies": F.size("__places"), "taken": F.size("__places") * F.col("size"), "positions": F.transform("__places", position)})
    rows = rows.withColumn("position", F.get("positions", F.lit(0)))
    return rows.drop("__source", "__none", "__bucket", "__s", "__n", "__b", "__start", "__inside", "__ramp", "__middle", "__places")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, source and others) with size, source_size, target, copies, taken, position and positions, by position.

    Columns of ``docs`` with one of these names are replaced. ``copies`` is how often the mix takes the document,
    ``positions`` its places in training; ``position`` is the first, null if it is not taken. Columns that the caller
    does not use afterwards (the text, say) are not shuffled.
    """
    rows = place(docs, **options)
    return rows.orderBy(F.col("position").asc_nulls_last(), "__key").drop("__key")  # the key parts what isn't taken into ranges too


def stream(docs: DataFrame, **options) -> DataFrame:
    """The mixed training stream itself: the columns of ``docs``, one row per taken pass, in training order."""
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken", "position", "positions")]
    clashing = {c: f"__own_{c}" for c in docs.columns if c not in names}
    out = place(docs.withColumnsRenamed(clashing), **options).where("copies > 0")
    out = out.select(*[F.col(clashing.get(c, c)).alias(c) for c in docs.columns], F.explode("positions").alias("__position"))
    return out.orderBy("__position").drop("__position")


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "position")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(i % 3 + 1)::INT] AS weight, [-0.5::DOUBLE, 0.5::DOUBLE, 0.0::DOUBLE][(i % 3 + 1)::INT] AS a FROM s),
p AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_,
             sum(weight) OVER (ORDER BY source_size / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
             (sum(source_size) OVER ())::BIGINT AS total FROM w),
l AS (SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * before_) / weight_left AS lv FROM p),
x AS (SELECT lv FROM l WHERE lv * weight <= 2.0::DOUBLE * source_size ORDER BY source_size / weight, i LIMIT 1),
t AS (SELECT source, source_size, a, least(2.0::DOUBLE * source_size, coalesce((SELECT lv FROM x) * weight, 2.0::DOUBLE * source_size)) AS target FROM l),
m AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.a,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + d.size / 2.0::DOUBLE AS mid
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (mid <= target)::INT + (mid + source_size <= target)::INT AS copies, least(mid / greatest(target, 1e-9::DOUBLE), 1.0::DOUBLE) AS y FROM m)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
       CASE WHEN copies = 0 THEN NULL WHEN a = 0 THEN y ELSE ((1 + a) - sqrt(greatest((1 + a) * (1 + a) - 4 * a * y, 0.0::DOUBLE))) / (2 * a) END AS position
FROM c
"""

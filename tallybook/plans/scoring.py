"""Scores of a load against ground truth, all as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import matching
from tallybook.plans.rows import ID

TRUTH_ROWS = (
    "book string, sheet_index int, sheet string, row_num int, domain string, kind string, record_id string, expected_outcome string, expected_reason string, "
    "true_date date, true_currency string, true_amount decimal(18,2), supplier_code string, supplier_raw string"
)


def read_truth(spark: SparkSession, truth_dir: str) -> dict[str, DataFrame]:
    csv = lambda name, schema: spark.read.csv(f"{truth_dir}/{name}.csv", header=True, schema=schema)
    return {
        "rows": csv("rows", TRUTH_ROWS),
        "supplier_aliases": csv("supplier_aliases", "alias string, supplier_code string"),
        "suppliers": csv("suppliers", "supplier_code string, canonical_name string, category string, currency string"),
        "manifest": spark.read.json(f"{truth_dir}/manifest.json", multiLine=True),
    }


def outcome_score(truth: DataFrame, outcomes: DataFrame) -> DataFrame:
    """expected, actual, n, example of every pair of outcomes (``missing`` where the load has no such row); agreement is where both are equal."""
    a = truth.select(*ID, F.concat_ws(":", "expected_outcome", F.nullif("expected_reason", F.lit(""))).alias("expected"))
    b = outcomes.select(*ID, F.concat_ws(":", "outcome", "reason_code").alias("got"))
    both = a.join(b, ID, "left").withColumn("actual", F.coalesce("got", F.lit("missing")))
    example = F.min(F.struct(*ID)).alias("example")
    return both.groupBy("expected", "actual").agg(F.count("*").alias("n"), example).withColumn("agree", F.col("expected") == F.col("actual"))


def supplier_score(aliases: DataFrame, truth: DataFrame, review: DataFrame) -> dict[str, DataFrame]:
    """pairs (precision, recall), false_merges (clusters of several suppliers), split (suppliers in several clusters), review hits."""
    both = aliases.select("alias", F.col("match_key").alias("cluster")).join(truth, "alias")
    merged = both.groupBy("cluster").agg(F.countDistinct("supplier_code").alias("suppliers"), F.array_join(F.sort_array(F.collect_set("supplier_code")), ", ").alias("codes")).where("suppliers > 1")
    split = both.groupBy("supplier_code").agg(F.countDistinct("cluster").alias("clusters")).where("clusters > 1")
    owner = both.groupBy("cluster").agg(F.first("supplier_code").alias("near_code"))
    queued = review.join(truth, "alias").join(owner, F.col("nearest") == F.col("cluster"), "left")
    hits = queued.agg(F.count("*").alias("queued"), F.count_if(F.col("supplier_code") == F.col("near_code")).alias("right"))
    return {"pairs": matching.pair_scores(both, "cluster", "supplier_code"), "false_merges": merged, "split": split, "review": hits}


def value_score(parsed: DataFrame, truth: DataFrame, value: str, true_value: str, by: str) -> DataFrame:
    """checked, right and up to five wrong examples of ``value`` against the truth, by ``by`` (date method, currency source)."""
    both = parsed.select(*ID, F.col(value).alias("v"), F.col(by).alias("by")).join(truth.select(*ID, F.col(true_value).alias("t")), ID)
    wrong = F.when(~F.col("v").eqNullSafe(F.col("t")), F.struct(*ID))
    return both.groupBy("by").agg(F.count("*").alias("checked"), F.count_if(F.col("v").eqNullSafe(F.col("t"))).alias("right"), F.slice(F.sort_array(F.collect_set(wrong)), 1, 5).alias("examples"))


def expected_records(truth: DataFrame) -> DataFrame:
    """Records that should be loaded, by domain."""
    return truth.where("expected_outcome = 'loaded'").groupBy("domain").agg(F.countDistinct("record_id").alias("expected"))

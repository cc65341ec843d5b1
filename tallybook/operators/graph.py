"""Tables that are computed once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The folder for tables on the way: the one that spark.checkpoint.dir names (a fresh local one where it is unset, as in tests)."""
    context = spark.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once: a checkpoint in the scratch folder."""
    scratch(df.sparkSession)
    return df.checkpoint()

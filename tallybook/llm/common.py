"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []
_kept: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; only Spark's readers open it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or (only where it is unset, as in tests) a fresh local one."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="spark-"))
    return _local[0]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and no lost executor takes the rows with it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _kept.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, since: int, but: int = 0) -> int:
    """Deletes what ``keep`` has written after the first ``since`` tables, but the last ``but``; returns how many are left.

    Only for one who knows that no later query reads them, such as a pipeline whose stage is written.
    """
    hadoop, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = _kept[since : len(_kept) - but]
    for p in old:
        path(p).getFileSystem(hadoop).delete(path(p), True)
    del _kept[since : since + len(old)]
    return len(_kept)


def kept_tables() -> int:
    return len(_kept)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python at most ``rows`` at a time: the default of 10,000 holds a whole file split in both processes at once."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def text_key(c: str | Column) -> Column:
    """128 bits of a text: equal for equal texts, null for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.substring(F.unhex(F.sha2(c, 256)), 1, 16))

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over some inputs, in their order."""

    def run(build, inputs, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
        return [r["y"] for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]

    return run

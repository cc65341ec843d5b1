"""Takes in workbooks as they arrive: every new file is unpacked once and its grid rows are appended, with exactly-once bookkeeping."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallybook.sources.workbook import SCHEMA, unpack

_FILES = "path string, modificationTime timestamp, length long, content binary"


def stage_new_books(spark: SparkSession, books_dir: str, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Starts a run over the files that have come since the last one; it ends by itself. Read ``out_dir`` as parquet with the grid schema."""

    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.xlsx").load(books_dir)
    grids = files.select("path", "content").mapInArrow(unpack, SCHEMA)
    return grids.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(out_dir)

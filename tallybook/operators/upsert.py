"""Idempotent upserts into parquet tables kept in key buckets, and runs that take effect at once or not at all.

A store is a folder. Each run writes below ``run=<run_id>``: of a keyed table the buckets that it changes, of other tables all
rows, and a manifest that names the files in force of every table and bucket, its own or those of earlier runs. The run takes
effect when its numbered pointer is created; creating fails if another run has taken the number, so of two loads that began from
the same snapshot one is refused and nothing of it is seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.operators.graph import settled


def diff(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """key, new (or kept) values, and action: insert, update, unchanged, or keep for what the new load hasn't got.

    Both sides must have the target's types already, else rounding shows as updates. Rows are never deleted.
    """
    a = old.select(*key, F.struct(*values).alias("__old"))
    b = new.select(*key, F.struct(*values).alias("__new"))
    both = a.join(b, key, "full")
    action = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "keep").when(F.col("__old").eqNullSafe(F.col("__new")), "unchanged").otherwise("update")
    both = both.withColumn("action", action).withColumn("__now", F.coalesce("__new", "__old"))
    return both.select(*key, "__now.*", "action")


def change_counts(table: str, changes: DataFrame) -> DataFrame:
    return changes.agg(F.count_if(F.col("action") == "insert").alias("inserted"), F.count_if(F.col("action") == "update").alias("updated")).select(F.lit(table).alias("table_name"), "inserted", "updated")


def assign_ids(rows: DataFrame, known: DataFrame, key: list[str], id_column: str, top: int | None = None) -> DataFrame:
    """``rows`` with their id from ``known`` (key, id); new keys go on after ``top``, or the largest known id, in key order.

    New keys are sorted into ranges and kept; counts of the ranges are accumulated, so no task sees all new keys.
    """
    joined = rows.join(known.select(*key, id_column), key, "left")
    fresh = joined.where(F.col(id_column).isNull()).select(*key).distinct()
    fresh = settled(fresh.repartitionByRange(*key).withColumn("__part", F.spark_partition_id()))
    sizes = fresh.groupBy("__part").agg(F.count("*").alias("n"))
    base = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__base"))
    last = known.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("__top")) if top is None else known.sparkSession.range(1).select(F.lit(top).cast("long").alias("__top"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*key))
    numbered = fresh.withColumn("__n", within).join(base, "__part").crossJoin(last).select(*key, (F.col("__top") + F.col("__base") + F.col("__n")).alias("__new"))
    return joined.join(numbered, key, "left").withColumn(id_column, F.coalesce(id_column, "__new")).drop("__new")


class ConcurrentLoad(RuntimeError):
    """Another run took effect after this one had read the store."""


#: Buckets of a keyed table: as many as make one a task's share.
BUCKETS = 16
_WHOLE = -1
_MANIFEST = "name string, bucket int, path string, top_id long, schema string, buckets int"


def bucket_of(key: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """The tables of one run: where their buckets are, their columns and largest ids. Number 0 is an empty store."""

    spark: SparkSession
    out_dir: str
    number: int = 0
    run_id: str = ""
    paths: dict[str, dict[int, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    tops: dict[str, int] = field(default_factory=dict)
    buckets: dict[str, int] = field(default_factory=dict)

    def __contains__(self, table: str) -> bool:
        return table in self.schemas

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """The table, or only some of its buckets."""
        if table not in self:
            raise FileNotFoundError(f"no {table} in {self.out_dir}")
        paths = sorted({p for b, p in self.paths[table].items() if buckets is None or b in buckets})
        if not paths:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*paths)


@dataclass(frozen=True)
class Staged:
    """A keyed table as a run would leave it: its buckets' paths, the changed rows, and their numbers."""

    paths: dict[int, str]
    schema: str
    top: int
    buckets: int
    inserted: int
    updated: int
    rewritten: list[int]
    changed: DataFrame
    full: DataFrame


def _pointers(spark: SparkSession, out_dir: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_pointers")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointer(spark: SparkSession, out_dir: str) -> tuple[int, str] | None:
    """(number, run_id) of the run in force; None before the first."""
    path, fs = _pointers(spark, out_dir)
    if not fs.exists(path):
        return None
    numbers = [n for f in fs.listStatus(path) if (n := f.getPath().getName()).isdigit()]
    if not numbers:
        return None
    stream = fs.open(path.suffix(f"/{max(numbers)}"))
    run_id = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return int(max(numbers)), run_id


def snapshot(spark: SparkSession, out_dir: str) -> Snapshot:
    """What is in force now; it stays readable when later runs take effect."""
    found = pointer(spark, out_dir)
    if not found:
        return Snapshot(spark, out_dir)
    paths: dict[str, dict[int, str]] = {}
    schemas, tops, buckets = {}, {}, {}
    for r in spark.read.schema(_MANIFEST).parquet(f"{out_dir}/run={found[1]}/_manifest").collect():  # a row for each table and bucket
        paths.setdefault(r["name"], {})
        if r["path"]:
            paths[r["name"]][r["bucket"]] = f"{out_dir}/{r['path']}"
        schemas[r["name"]], tops[r["name"]], buckets[r["name"]] = r["schema"], r["top_id"], r["buckets"]
    return Snapshot(spark, out_dir, *found, paths, schemas, tops, buckets)


def current(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    found = snapshot(spark, out_dir)
    if not found.number:
        raise FileNotFoundError(f"no load in {out_dir}")
    return found.read(table)


def stage(before: Snapshot, run_id: str, table: str, rows: DataFrame, key: list[str], values: list[str], id_column: str | None = None, buckets: int = BUCKETS) -> Staged:
    """Writes the buckets of ``table`` that ``rows`` change, with ids for new keys; nothing is in force until ``publish``.

    Only the buckets that hold a key of ``rows`` are read, and only those in which a row is new or changed are written. Rows stay in
    their bucket and keep their id; none is deleted.
    """
    spark, buckets = before.spark, before.buckets.get(table, buckets)  # a table keeps the number that it began with
    new = settled(rows.select(*key, *values, bucket_of(key, buckets).alias("__bucket")))
    touched = [r[0] for r in new.select("__bucket").distinct().collect()]
    columns = [*([id_column] if id_column else []), *key, *values]
    schema = ", ".join([*([f"{id_column} long"] if id_column else []), *[f"`{c}` {t}" for c, t in rows.select(*key, *values).dtypes]])
    old = before.read(table, touched).select(*columns) if table in before else spark.createDataFrame([], schema)
    changes = diff(old, new, key, values)
    if id_column:
        changes = assign_ids(settled(changes), old.select(*key, id_column), key, id_column, before.tops.get(table, 0))
    changes = settled(changes.withColumn("__bucket", bucket_of(key, buckets)))
    counts = changes.where("action IN ('insert', 'update')").groupBy("__bucket", "action").agg(F.count("*").alias("n")).collect()
    total = lambda action: sum(r["n"] for r in counts if r["action"] == action)
    rewritten = sorted({r["__bucket"] for r in counts})
    paths = dict(before.paths.get(table, {}))
    if rewritten:
        out = changes.where(F.col("__bucket").isin(rewritten)).select("__bucket", *columns)
        out.repartition(len(rewritten), "__bucket").write.partitionBy("__bucket").parquet(f"{before.out_dir}/run={run_id}/{table}")
        paths |= {b: f"{before.out_dir}/run={run_id}/{table}/__bucket={b}" for b in rewritten}
    full = spark.read.schema(schema).parquet(*sorted(paths.values())) if paths else spark.createDataFrame([], schema)
    top = before.tops.get(table, 0) + (total("insert") if id_column else 0)
    return Staged(paths, schema, top, buckets, total("insert"), total("update"), rewritten, changes.where("action IN ('insert', 'update')").select(*columns), full)


def publish(before: Snapshot, run_id: str, staged: dict[str, Staged], whole: dict[str, DataFrame]) -> Snapshot:
    """Writes the ``whole`` tables and the manifest, then creates the pointer that follows ``before``'s, if no other run has.

    The file system must create a file only where there is none, as HDFS does.
    """
    spark, out_dir = before.spark, before.out_dir
    near = lambda p: p.removeprefix(f"{out_dir}/")
    manifest = []
    for name, s in staged.items():
        manifest += [(name, b, near(p), s.top, s.schema, s.buckets) for b, p in s.paths.items()] or [(name, _WHOLE, None, s.top, s.schema, s.buckets)]
    for name, df in whole.items():
        df.write.parquet(f"{out_dir}/run={run_id}/{name}")
        manifest.append((name, _WHOLE, f"run={run_id}/{name}", 0, ", ".join(f"`{c}` {t}" for c, t in df.dtypes), 0))
    kept = set(before.schemas) - set(staged) - set(whole)
    manifest += [(name, b, p and near(p), before.tops[name], before.schemas[name], before.buckets[name]) for name in kept for b, p in (before.paths[name] or {_WHOLE: None}).items()]
    spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.parquet(f"{out_dir}/run={run_id}/_manifest")
    path, fs = _pointers(spark, out_dir)
    try:
        stream = fs.create(path.suffix(f"/{before.number + 1:012d}"), False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise ConcurrentLoad(f"a load took effect since number {before.number}") from None
        raise
    stream.write(bytearray(run_id.encode()))
    stream.close()
    return snapshot(spark, out_dir)

"""k-means on integers, with lower bounds that loosen by less than the centroids' full drift.

A vector's components become integers (``floor(scale * x)``), so distances, means and ties are exact and every run agrees. Each vector
carries its cluster, an upper bound of the distance to that centroid and a lower bound of the distance to any other. When
centroids have moved, the upper bound grows by its own centroid's drift. How much nearer another centroid can have come depends
on where the cluster lies: all its vectors are in a sphere around their old centroid, and in the plane through that sphere's
centre and the line on which centroid j moved, the distance to j falls at the rate of the cosine between the move and the sight
of the vector. Over the sphere the cosine is at most that of the tangent nearest to the line of the move, and as j moves on
the tangent only turns away, so the mean over the tangents at a few places of the way bounds the fall (a centroid that moves
away even raises the bound). Each cluster has a few spheres around the same centre, and a vector takes the smallest that holds it. A vector whose upper bound stays below its lower bound, or below half the way to the nearest other
centroid, keeps its cluster; every other one is ambiguous and scanned against all centroids exactly.

A round is one map over the vectors, written to the shared folder: bounds and vectors stay in their rows and nothing is
shuffled but each Arrow batch's sums by cluster. The driver gets k rows of sums a round.

Edge cases: vectors that are null, of another length, or hold null or non-finite components are left out; components beyond
about 2^27 after scaling are held there, so that squared distances fit a long; repeated rows and equal ids count each (equal hashes
of the start go by their components); an id that is null hashes as the empty text; fewer vectors than ``k`` give fewer
centroids; an empty table gives no rows; ties go to the smaller centroid; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import forget, keep, kept_tables, table

#: Relative slack of the bounds against rounding, and spheres of each cluster.
SLACK, SPHERES = 1e-9, 8


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal length and without nulls."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1 if len(values) else 0)


def as_lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32), x.reshape(-1))


def integers(vectors: DataFrame, key: str, column: str, dims: int, scale: int) -> DataFrame:
    """(key, v array<int>) of the vectors that take part."""
    limit = 2 ** int(np.log2((2**61 / dims) ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch[column]
            fits = np.flatnonzero((lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == dims))
            if not len(fits):
                continue
            taken = lists.take(pa.array(fits))
            x = taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fits), dims)
            fine = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                v = np.floor(np.clip(scale * x[fine], -limit, limit)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(fits[fine])), as_lists(v)], names=[key, "v"])

    return vectors.select(key, column).mapInArrow(run, f"{key} {vectors.schema[key].dataType.simpleString()}, v array<int>")


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer points, as int64."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(points).max(initial=0)), 1)
    if 4 * x.shape[1] * most * most < 2**53:  # whole numbers that doubles hold exactly
        a, b = x.astype(np.float64), points.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.empty((len(x), len(points)), np.int64)
    for j, p in enumerate(points.astype(np.int64)):
        out[:, j] = ((x.astype(np.int64) - p) ** 2).sum(axis=1)
    return out


def own_squared(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the row beside it."""
    gap = x.astype(np.int64) - own
    return np.einsum("ij,ij->i", gap, gap)


def falls(old: np.ndarray, new: np.ndarray, radii: np.ndarray, places: int = 4) -> np.ndarray:
    """[i, j]: how much less far, at most, any point within ``radii[i]`` of ``old[i]`` can be from ``new[j]`` than from ``old[j]``."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    move = new - old
    length = np.linalg.norm(move, axis=1)
    along = move / np.where(length > 0, length, 1)[:, None]
    total = np.zeros((len(old), len(old)))
    for s in range(places):
        at = old + s / places * move
        sight = old[:, None, :] - at[None, :, :]
        far = np.linalg.norm(sight, axis=2)
        outside = far > radii[:, None]
        far = np.where(outside, far, 1)
        cosine = np.clip(np.einsum("ijd,jd->ij", sight, along) / far, -1, 1)
        spread = np.where(outside, np.minimum(radii[:, None] / far, 1), 1)  # sine of the angle between the centre and a tangent
        narrow = np.sqrt(1 - spread**2)
        tangent = cosine * narrow + np.sqrt(1 - cosine**2) * spread
        total += np.where(outside & (cosine < narrow), tangent, 1)  # else the line of the move meets the sphere's cone
    return np.minimum(length, length * (total / places + 1e-7))


@dataclass(frozen=True)
class Move:
    """What a round knows of the centroids: where they are and, but for the first round, how far each has moved and the lower bounds of its spheres fall."""

    points: np.ndarray
    drift: np.ndarray | None = None
    radii: np.ndarray | None = None  # of the largest spheres
    loosened: np.ndarray | None = None  # [cluster, sphere]

    def half(self) -> np.ndarray:
        """Half the distance of each centroid to the nearest other."""
        d = squared(self.points, self.points).astype(np.float64)
        np.fill_diagonal(d, np.inf)
        return np.sqrt(d.min(axis=1, initial=np.inf)) / 2


def reassign(x: np.ndarray, move: Move, half: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """cluster, upper and lower after a move, and how many vectors were scanned."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    if move.drift is None:
        open_ = np.arange(len(x))
    else:
        sphere = np.clip(np.ceil(upper * (1 + SLACK) / np.maximum(move.radii[cluster], SLACK) * SPHERES), 1, SPHERES).astype(int) - 1
        lower -= move.loosened[cluster, sphere]
        upper += move.drift[cluster] * (1 + SLACK)
        bound = np.maximum(lower, half[cluster]) * (1 - SLACK)
        open_ = np.flatnonzero(upper * (1 + SLACK) + SLACK >= bound)
        upper[open_] = np.sqrt(own_squared(x[open_], move.points[cluster[open_]]))
        open_ = open_[upper[open_] * (1 + SLACK) + SLACK >= bound[open_]]
    if len(open_):
        d = squared(x[open_], move.points)
        best = d.argmin(axis=1)  # of equal ones the first
        rows = np.arange(len(open_))
        cluster[open_], upper[open_] = best, np.sqrt(d[rows, best])
        if d.shape[1] > 1:
            d[rows, best] = np.iinfo(np.int64).max
            lower[open_] = np.sqrt(d.min(axis=1))
        else:
            lower[open_] = np.inf
    return cluster, upper, lower, len(open_)


_SUMS = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("radius", pa.float64()), ("totals", pa.list_(pa.int64()))]))


def _sums(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray) -> list[dict]:
    order = np.argsort(cluster, kind="stable")
    which, start, n = np.unique(cluster[order], return_index=True, return_counts=True)
    totals = np.add.reduceat(x[order].astype(np.int64), start, axis=0)
    radii = np.maximum.reduceat(upper[order], start)
    return [{"cluster": int(c), "n": int(m), "radius": float(r), "totals": t.tolist()} for c, m, r, t in zip(which, n, radii, totals, strict=True)]


def _round(rows: DataFrame, key: str, move: Move) -> DataFrame:
    """``rows`` (key, v and, but for the first round, cluster, upper, lower) after the move; the first row of each batch holds the batch's sums."""
    half, first = move.half(), move.drift is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = matrix(batch["v"]), batch.num_rows
            state = (np.zeros(n, np.int64), np.zeros(n), np.zeros(n)) if first else (batch["cluster"].to_numpy().astype(np.int64), batch["upper"].to_numpy(), batch["lower"].to_numpy())
            cluster, upper, lower, scanned = reassign(x, move, half, *state)
            sums = pa.array([_sums(x, cluster, upper)] + [None] * (n - 1), _SUMS)
            counts = pa.array([scanned] + [None] * (n - 1), pa.int64())
            yield pa.RecordBatch.from_arrays([batch[key], batch["v"], pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), sums, counts], names=[key, "v", "cluster", "upper", "lower", "sums", "scanned"])

    kind = rows.schema[key].dataType.simpleString()
    taken = rows.select(key, "v") if first else rows.select(key, "v", "cluster", "upper", "lower")
    return taken.mapInArrow(run, f"{key} {kind}, v array<int>, cluster int, upper double, lower double, sums array<struct<cluster:int,n:long,radius:double,totals:array<long>>>, scanned long")


def _distances(rows: DataFrame, key: str, points: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = own_squared(matrix(batch["v"]), points[batch["cluster"].to_numpy()]) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch[key], batch["cluster"], pa.array(own)], names=[key, "cluster", "distance"])

    return rows.select(key, "v", "cluster").mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, cluster int, distance long")


@dataclass
class Clustering:
    """rows (key, cluster, distance), the final centroids, and the number of vectors scanned in each assignment."""

    rows: DataFrame
    points: np.ndarray
    scanned: list[int]


def cluster(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", full_drift: bool = False) -> Clustering:
    """k-means of ``vectors``: ``rounds`` of assigning and averaging from the ``k`` first by hash, then a last assignment.

    ``full_drift`` loosens bounds by the largest drift instead (for comparison; the result is the same).
    """
    spark, begun = vectors.sparkSession, kept_tables()
    rows = keep(integers(vectors, key, column, dims, scale), "drift-vectors")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    points = np.array([r["v"] for r in rows.select("v", place.alias("h")).orderBy("h", "v").limit(k).collect()], np.int64).reshape(-1, dims)
    if not len(points):
        return Clustering(rows.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), points, [])
    move, scanned = Move(points), []
    for n in range(rounds + 1):
        rows = keep(_round(rows, key, move), "drift-round")
        forget(spark, begun, but=1)  # the round is written and reads nothing of the last
        told = rows.where("sums IS NOT NULL")
        if n == rounds:
            scanned.append(told.agg(F.sum("scanned")).first()[0])
            break
        each = told.select("scanned", F.explode("sums").alias("s")).select("s.*")
        many = each.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()
        parts = each.select("cluster", F.posexplode("totals").alias("d", "t")).groupBy("cluster", "d").agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()
        scanned.append(told.agg(F.sum("scanned")).first()[0])
        size, radii = {r["cluster"]: r["n"] for r in many}, np.zeros(len(points))
        moved = move.points.copy()
        for r in many:
            radii[r["cluster"]] = r["radius"] * (1 + 2 * SLACK)
        for r in parts:
            moved[r["cluster"], r["d"]] = int(r["t"]) // size[r["cluster"]]  # floors, whatever the sign
        drift = np.linalg.norm((moved - move.points).astype(np.float64), axis=1)
        loosened = np.zeros((len(points), SPHERES))
        for b in range(SPHERES if len(points) > 1 else 0):
            fall = np.broadcast_to(drift, (len(points), len(points))).copy() if full_drift else falls(move.points, moved, radii * (b + 1) / SPHERES)
            np.fill_diagonal(fall, -np.inf)
            loosened[:, b] = fall.max(axis=1)
        move = Move(moved, drift, radii, loosened)
    return Clustering(_distances(rows, key, move.points), move.points, scanned)


def digest(point: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest()


def op11_drift_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    rows = keep(found.rows, "drift-assigned")
    inertia = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    told = [(c, d, sum(inertia.values()), digest(found.points[c])) for c, d in inertia.items()]
    each = spark.createDataFrame(told, "__c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(each), F.col("cluster") == F.col("__c")).drop("__c")  # at most k rows


def _oracle(k: int = 40, rounds: int = 5) -> str:
    dot = lambda a, b: f"list_dot_product({a}::DOUBLE[], {b}::DOUBLE[])"
    sql = [
        """v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS c, v FROM v QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        sql.append(f"""d{i} AS MATERIALIZED (SELECT vec_id, v, list_transform(cs, lambda c: {dot("v", "v")} - 2 * {dot("v", "c")} + {dot("c", "c")}) AS ds FROM v, (SELECT list(v ORDER BY c) AS cs FROM c{i}))""")
        sql.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, list_position(ds, list_min(ds)) - 1 AS c, list_min(ds)::BIGINT AS d FROM d{i})""")
        if i < rounds:
            sql.append(f"""s{i} AS (SELECT c, p, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY c, p),
m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS w FROM s{i} GROUP BY c), c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(w, v) AS v FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c)""")
    return f"""WITH {", ".join(sql)}
SELECT vec_id, a.c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON f.c = a.c"""


ORACLE = _oracle()

"""Near-duplicate embeddings by lattice hashing.

Vectors of one label and equal components are one vertex with a count. Each unit vector is projected to eight random
directions in each of ``tables`` tables, scaled, shifted, and decoded to the nearest point of the E8 lattice; the point
(with table and label) is its cell. A vector is stored in its own cell and also looks into the ``probes`` neighbouring
cells (lattice points one root away) that lie nearest to it. Whoever meets in a cell is a candidate pair, verified by cosine in
double precision on the original vectors.

Pairs are never written out. Each cell that holds two vectors is cut into blocks of about ``block`` owners and ``block`` lookers,
and each pair of blocks is one small group. A pair counts only where it meets first: vectors carry the hashes of all of their cells, so
a task sees whether two of them have met in an earlier table or, in this one, in the other's cell. What leaves the task is each
vector's number of links (counted with the copies) and the few links that join parts of the group; components come from those.

Recall against brute force is measured in the tests; with these parameters it is above 0.99 at cosine 0.98.

Edge cases: vectors that are null, empty, all zeros, or hold null or non-finite components, and vectors with a null
label, link with nothing and are components of their own; vectors of different lengths don't link; repeated rows are
rows of their own that link with each other; a null vec_id is passed through; ties don't arise (every link counts); other columns are
left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table
from tallybook.llm.components import components
from tallybook.llm.vectors import as_matrix, cosine, unit, usable


BATCH = 20_000


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        v = np.array([0.5 if bits >> i & 1 else -0.5 for i in range(8)])
        if v.sum() % 2 == 0:
            out.append(v)
    return np.array(out)


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8, which is D8 (integers of an even sum) and D8 shifted by 1/2."""

    def d8(z: np.ndarray) -> np.ndarray:
        r = np.rint(z)
        off = z - r
        rows = np.flatnonzero(r.sum(axis=1) % 2 != 0)
        worst = np.abs(off).argmax(axis=1)[rows]
        r[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
        return r

    whole, half = d8(y), d8(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _cells(x: np.ndarray, number: int, scale: float, probes: int, seed: int) -> np.ndarray:
    """[n, 1 + probes] hashes of the own cell and the probed ones, in one table, for unit vectors."""
    rng = np.random.default_rng([seed, number, x.shape[1]])
    directions = rng.standard_normal((x.shape[1], 8))
    if x.shape[1] >= 8:
        directions = np.linalg.qr(directions)[0]
    y = x @ directions * scale * np.sqrt(x.shape[1] / 64) + rng.random(8)
    own = decode(y)
    g = roots()
    toward = np.argsort(-((y - own) @ g.T), axis=1, kind="stable")[:, :probes]
    points = np.concatenate([own[:, None, :], own[:, None, :] + g[toward]], axis=1)
    factors = rng.integers(1, 2**62, 8)
    return (np.rint(points * 2).astype(np.int64) * factors).sum(axis=2) + int(rng.integers(1, 2**62))


def cells(vertices: DataFrame, tables: int, scale: float, probes: int, seed: int = 5) -> DataFrame:
    """``vertices`` (v, label, vector) -> v, at: for each table the hash of the own cell, then of the probed ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["vector"].to_pylist()
            lengths, out = np.array([len(x) for x in vectors]), np.zeros((len(vectors), tables, 1 + probes), np.int64)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = unit(as_matrix([vectors[i] for i in at]))
                for t in range(tables):
                    out[at, t] = _cells(x, t, scale, probes, seed)
            offsets = np.arange(len(vectors) + 1, dtype=np.int32) * tables * (1 + probes)
            yield pa.RecordBatch.from_arrays([batch["v"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))], names=["v", "at"])

    return vertices.select("v", "vector").mapInArrow(run, "v long, at array<long>")


def _linked(groups: DataFrame, tables: int, probes: int, threshold: float) -> DataFrame:
    """``groups`` (key, cell, t, i, j, left, v, vector, at, copies) -> v, n (links found, with copies), and a, b (links that tie parts).

    A task works through its sorted rows some groups at a time: small groups all at once, pair by pair, larger ones by a product each.
    """
    many, small = 1 + probes, 4096

    def one(got: pa.Table) -> Iterator[pa.RecordBatch]:
        v, copies, t, cell, left = (got[c].to_numpy() for c in ("v", "copies", "t", "cell", "left"))
        number = np.zeros(len(v), np.int64)
        number[1:] = np.cumsum(changes(got))
        at = got["at"].combine_chunks().flatten().to_numpy().reshape(len(v), tables, many)
        own = at[np.arange(len(v)), t, 0] == cell
        vectors = got["vector"].combine_chunks()
        lengths, values = pc.list_value_length(vectors).to_numpy(), vectors.flatten().to_numpy().astype(np.float64)
        begins = np.cumsum(lengths) - lengths
        counts, ties = np.zeros(len(v), np.int64), []

        def count(a: np.ndarray, b: np.ndarray, x: np.ndarray, about: np.ndarray, place: np.ndarray) -> None:
            """Counts the pairs (a owns the cell, b looks into it) that are alike and have not met elsewhere."""
            near = (about >= threshold - 1e-9) & (v[a] != v[b]) & (~own[b] | (v[a] < v[b]))  # two owners stand in both orders
            a, b, about = a[near], b[near], about[near]
            sure = about >= threshold + 1e-9
            sure[~sure] = cosine(x[place[a[~sure]]], x[place[b[~sure]]]) >= threshold
            a, b = a[sure], b[sure]
            # not where they have met in an earlier table, or in this one in the smaller one's cell
            one, two, now = at[a], at[b], t[a]
            met = ((one[:, :, :1] == two).any(axis=2) | (two[:, :, :1] == one).any(axis=2)) & (np.arange(tables) < now[:, None])
            rows = np.arange(len(a))
            back = ~own[b] & (one[rows, now, :] == two[rows, now, :1]).any(axis=1) & (v[a] > v[b])
            fresh = ~met.any(axis=1) & ~back
            a, b = a[fresh], b[fresh]
            counts[:] += (np.bincount(a, copies[b], len(v)) + np.bincount(b, copies[a], len(v))).astype(np.int64)
            ties.extend(spanning(v[a], v[b]))

        for d in np.unique(lengths):
            mine = np.flatnonzero(lengths == d)
            x = values[begins[mine][:, None] + np.arange(d)]
            place = np.zeros(len(v), np.int64)
            place[mine] = np.arange(len(mine))
            u = unit(x)
            owners, lookers = mine[left[mine]], mine[~left[mine]]
            size = number[-1] + 1
            n_own, n_look = np.bincount(number[owners], minlength=size), np.bincount(number[lookers], minlength=size)
            first_own, first_look = np.cumsum(n_own) - n_own, np.cumsum(n_look) - n_look
            pairs = n_own * n_look
            few = np.flatnonzero((pairs > 0) & (pairs <= small))
            ends = np.cumsum(pairs[few])
            for p in range(0, int(ends[-1]) if len(few) else 0, 20_000):
                k = np.arange(p, min(p + 20_000, int(ends[-1])))
                g = np.searchsorted(ends, k, side="right")
                inside, g = k - (ends[g] - pairs[few[g]]), few[g]
                a, b = owners[first_own[g] + inside // n_look[g]], lookers[first_look[g] + inside % n_look[g]]
                count(a, b, x, np.einsum("ij,ij->i", u[place[a]], u[place[b]]), place)
            for g in np.flatnonzero(pairs > small):
                r, c = owners[first_own[g] : first_own[g] + n_own[g]], lookers[first_look[g] : first_look[g] + n_look[g]]
                about = u[place[r]] @ u[place[c]].T
                near = np.argwhere(about >= threshold - 1e-9)
                for p in range(0, len(near), 20_000):
                    i, j = near[p : p + 20_000].T
                    count(r[i], c[j], x, about[i, j], place)
        ids, same = np.unique(v, return_inverse=True)
        total = np.bincount(same, counts).astype(np.int64)
        found, tied = np.flatnonzero(total), np.array(sorted(set(ties)), np.int64).reshape(-1, 2)
        tied = np.array(spanning(tied[:, 0], tied[:, 1]), np.int64).reshape(-1, 2)
        none = lambda n: pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(total[found]), none(len(found)), none(len(found))], names=["v", "n", "a", "b"])
        yield pa.RecordBatch.from_arrays([none(len(tied)), none(len(tied)), pa.array(tied[:, 0]), pa.array(tied[:, 1])], names=["v", "n", "a", "b"])

    def changes(got: pa.Table) -> np.ndarray:
        new = np.zeros(max(len(got) - 1, 0), bool)
        for c in order:
            x = got[c].to_numpy()
            new |= x[1:] != x[:-1]
        return new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:  # sorted, so that only the last group of what is held may go on
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH:
                got = pa.Table.from_batches(held).combine_chunks()
                ends = np.flatnonzero(changes(got))
                if len(ends):
                    yield from one(got.slice(0, int(ends[-1]) + 1).combine_chunks())
                    got = got.slice(int(ends[-1]) + 1)
                held, rows = got.combine_chunks().to_batches(), len(got)
        if rows:
            yield from one(pa.Table.from_batches(held).combine_chunks())

    order = ["key", "cell", "t", "i", "j"]
    dealt = groups.select(*order, "left", "v", "vector", "at", "copies").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "v long, n long, a long, b long")


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of ``a`` and ``b`` that already tie all that these links tie."""
    if not len(a):
        return []
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(ids))
    while True:  # the smallest number reachable, in rounds
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(ids[label[k]]), int(ids[k])) for k in range(len(ids)) if label[k] != k]


def near_duplicates(rows: DataFrame, threshold: float = 0.98, tables: int = 8, scale: float = 6.0, probes: int = 4, block: int = 1000) -> DataFrame:
    """``rows`` (vec_id, embedding, label) -> vec_id, n_links, component_id, kept; one row per row."""
    rows = keep(rows.select("vec_id", "label", "embedding", (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("use")), "lattice-rows")
    vertices = rows.where("use").groupBy("label", F.col("embedding").alias("vector")).agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    vertices = keep(vertices.withColumn("v", F.monotonically_increasing_id()), "lattice-vertices")
    at = keep(cells(vertices, tables, scale, probes).join(vertices.select(F.col("v").alias("__v"), "label", "vector", "copies"), F.col("v") == F.col("__v")).drop("__v"), "lattice-cells")
    looks = at.select("v", "label", F.posexplode("at").alias("p", "cell"))
    looks = looks.select("v", "label", F.floor(F.col("p") / (1 + probes)).cast("int").alias("t"), (F.col("p") % (1 + probes) == 0).alias("own"), "cell")
    full = looks.groupBy("t", "cell", "label").agg(F.count_if("own").alias("owners"), F.count("*").alias("lookers")).where("owners > 0 and lookers > 1")
    full = keep(full.select(F.col("t").alias("__t"), F.col("cell").alias("__cell"), F.col("label").alias("__label"), F.ceil(F.col("owners") / block).cast("int").alias("ni"), F.ceil(F.col("lookers") / block).cast("int").alias("nj")), "lattice-full")
    here = keep(looks.join(full, (F.col("t") == F.col("__t")) & (F.col("cell") == F.col("__cell")) & (F.col("label") == F.col("__label"))).select("v", F.xxhash64("label", "cell", "t").alias("key"), "t", "own", "cell", "ni", "nj"), "lattice-here")
    mine = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = here.where("own").select("v", "key", "t", "cell", mine("ni").alias("i"), every("nj").alias("j"), F.lit(True).alias("left"))
    right = here.select("v", "key", "t", "cell", every("ni").alias("i"), mine("nj").alias("j"), F.lit(False).alias("left"))
    groups = left.unionAll(right).join(at.select(F.col("v").alias("__v"), "vector", "at", "copies"), F.col("v") == F.col("__v")).drop("__v")
    found = keep(_linked(groups, tables, probes, threshold), "lattice-links")
    others = found.where("v IS NOT NULL").groupBy(F.col("v").alias("o")).agg(F.sum("n").alias("others"))
    labels = components(found.where("a IS NOT NULL").select("a", "b").distinct())
    v = vertices.join(others, F.col("v") == F.col("o"), "left").join(labels.withColumnRenamed("v", "w"), F.col("v") == F.col("w"), "left")
    v = v.select("label", "vector", "copies", "first", F.coalesce("component", "v").alias("component"), F.coalesce("others", F.lit(0)).alias("others"))
    smallest = v.groupBy("component").agg(F.min("first").alias("component_id")).withColumnRenamed("component", "__c")
    v = keep(v.join(smallest, F.col("component") == F.col("__c")).select(F.col("label").alias("__label"), "vector", (F.col("copies") - 1 + F.col("others")).alias("n_links"), "component_id"), "lattice-named")
    out = rows.join(v, F.col("use") & (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op6_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH r AS (SELECT row_number() OVER () AS i, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM r WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.i AS a, b.i AS b FROM u a JOIN u b ON a.label = b.label AND a.i <> b.i AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
c AS (WITH RECURSIVE c(v, c) USING KEY (v) AS (
        SELECT i, i FROM r
        UNION SELECT l.a, min(c.c) FROM c JOIN l ON l.b = c.v JOIN recurring.c AS o ON o.v = l.a WHERE c.c < o.c GROUP BY l.a) SELECT v, c FROM c),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
k AS (SELECT c.c, min(r.vec_id) AS component_id FROM c JOIN r ON r.i = c.v GROUP BY c.c)
SELECT r.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, k.component_id, coalesce(r.vec_id = k.component_id, true) AS kept
FROM r JOIN c ON c.v = r.i JOIN k ON k.c = c.c LEFT JOIN n ON n.a = r.i
"""

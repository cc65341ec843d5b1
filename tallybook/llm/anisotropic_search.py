"""Nearest neighbours by score-aware anisotropic quantisation.

Vectors are scaled to length one, so the largest inner product is the largest cosine. Each is coded by a product
quantiser of two-dimensional parts with 16 centroids each (four bits a part). Codebooks and codes minimise the
anisotropic loss: the part of the residual that is parallel to the vector, which moves its score for the queries it
answers, weighs ``eta`` times the orthogonal part, with ``eta = (d - 1) T^2 / (1 - T^2)``. Codes and centroids are set in turns by coordinate
descent over the parts, on a bounded sample; memory goes with the sample, whatever the length of the vectors. What the codes leave
is coded once more in the same way, by its plain distance.

Queries and rows are dealt into blocks of bounded size, and every block of queries meets every block of rows once (the
stated query set against all rows). In a pair of blocks each query sums its table entries by the rows' codes, and the
``rerank`` best distinct vectors by that sum are scored exactly on the original vectors. A row's score is at most its sum plus
the length of its residual; all others whose bound reaches the last score needed get the sum of their second codes, which leaves a
residual of about a third, and those whose new bound still reaches it are scored exactly too, ``rerank`` at a
time in the order of their bounds, until none is left; so the search loses nothing to the codes, also among near copies. The best
``k`` go on; a window with a partial limit takes the best of all blocks. Equal vectors are scored once and stand in the
order of their ids.

Recall against brute force is measured in the tests (1 but for ties in the last digits).

Vectors travel in their own type (four bytes a component for floats) and are widened to doubles in the task.

Edge cases: vectors that are null, empty, all zeros, or hold null or non-finite components take no part; a row with a null vec_id
is a candidate like any other (ties put it last) and asks only if ``is_query`` holds for it; other columns are left out; vectors of another length than a query's are no candidates for it; repeated rows are candidates of their
own; fewer than ``k`` candidates give as many rows; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table
from tallybook.llm.vectors import as_matrix, cosine, sample_of, unit, usable

PART, CENTROIDS = 2, 16
SLACK = 1e-4  # above the rounding of the tables and sums in single precision


def parts(x: np.ndarray) -> np.ndarray:
    """[n, parts, PART], filled up with zeros."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % PART))).reshape(len(x), -1, PART)


def encode(x: np.ndarray, books: np.ndarray, eta: float, sweeps: int = 2) -> np.ndarray:
    """Codes [n, parts] of unit vectors ``x`` [n, parts, PART] under the anisotropic loss; ``books`` [parts, CENTROIDS, PART]."""
    n, m, _ = x.shape
    distance = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    codes = distance.argmin(axis=2)
    rows = np.arange(n)
    along = ((x[:, :, None, :] - books[None]) * x[:, :, None, :]).sum(axis=3)  # each choice's share of residual . x
    total = np.take_along_axis(along, codes[:, :, None], axis=2)[:, :, 0].sum(axis=1)
    for _ in range(sweeps):
        for p in range(m):
            other = total - along[rows, p, codes[:, p]]
            loss = distance[:, p] + (eta - 1) * (other[:, None] + along[:, p]) ** 2
            codes[:, p] = loss.argmin(axis=1)
            total = other + along[rows, p, codes[:, p]]
    return codes


def refit(x: np.ndarray, books: np.ndarray, codes: np.ndarray, eta: float) -> None:
    """Moves the centroids of one part after the other to where the anisotropic loss is least, the others and all codes as they are: a small system for each."""
    n, m, width = x.shape
    share = lambda p: (x[:, p] * (x[:, p] - books[p, codes[:, p]])).sum(axis=1)
    total = sum(share(p) for p in range(m))
    for p in range(m):
        k, xp = codes[:, p], x[:, p]
        other = total - share(p)
        left, right = np.zeros((CENTROIDS, width, width)), np.zeros((CENTROIDS, width))
        np.add.at(left, k, np.eye(width) + (eta - 1) * xp[:, :, None] * xp[:, None, :])
        np.add.at(right, k, xp * (1 + (eta - 1) * (other + (xp * xp).sum(axis=1)))[:, None])
        used = np.bincount(k, minlength=CENTROIDS) > 0
        books[p, used] = np.linalg.solve(left[used], right[used][:, :, None])[:, :, 0]
        total = other + share(p)


def residual(x: np.ndarray, books: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return x - books[np.arange(len(books)), codes]


def pack(codes: np.ndarray) -> np.ndarray:
    """Two codes a byte."""
    codes = np.pad(codes.astype(np.uint8), ((0, 0), (0, codes.shape[1] % 2)))
    return codes[:, 0::2] | codes[:, 1::2] << 4


def unpack(packed: np.ndarray) -> np.ndarray:
    codes = np.empty((len(packed), packed.shape[1] * 2), np.uint8)
    codes[:, 0::2], codes[:, 1::2] = packed & 15, packed >> 4
    return codes


def sums(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Each row's entries of a query's ``table`` [parts, CENTROIDS] added up."""
    out = np.zeros(len(codes), np.float32)
    for p in range(len(table)):
        out += table[p][codes[:, p]]
    return out


def train(x: np.ndarray, eta: float, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """Codebooks for unit vectors ``x`` [n, parts, PART]."""
    n, m, _ = x.shape
    rng = np.random.default_rng(seed)
    books = x[rng.choice(n, CENTROIDS, replace=n < CENTROIDS)].transpose(1, 0, 2).copy()
    for r in range(rounds + 6):
        anisotropic = r >= 6
        codes = encode(x, books, eta if anisotropic else 1.0, 2 if anisotropic else 0)
        if not anisotropic:
            for p in range(m):
                for k in range(CENTROIDS):
                    mine = codes[:, p] == k
                    if mine.any():
                        books[p, k] = x[mine, p].mean(axis=0)
            continue
        refit(x, books, codes, eta)
    return books


def search(rows: DataFrame, is_query: Column, k: int = 5, rerank: int = 128, sample: int = 4096, threshold: float = 0.2, row_block: int = 4096, query_block: int = 4096) -> DataFrame:
    """``rows`` (vec_id, embedding) -> query_id, rank, vec_id, score for the rows that ``is_query`` holds for."""
    clean = rows.where(usable(F.col("embedding"))).select("vec_id", F.col("embedding").alias("vector"))
    clean = clean.withColumn("dim", F.size("vector"))
    books: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
    for dim in [r[0] for r in clean.select("dim").distinct().collect()]:
        x = parts(unit(as_matrix(r[0] for r in sample_of(clean.where(F.col("dim") == dim).select("vector", "vec_id"), "vec_id", sample).collect())))
        eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
        first = train(x, eta)
        books[dim] = (first, train(residual(x, first, encode(x, first, eta)), 1.0), eta)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["code"], pdf["code2"] = None, None
            pdf["off"], pdf["off2"] = 0.0, 0.0
            for dim, at in pdf.groupby("dim").indices.items():
                b1, b2, eta = books[int(dim)]
                x = parts(unit(as_matrix(pdf["vector"].iloc[at])))
                codes = encode(x, b1, eta)
                left = residual(x, b1, codes)
                codes2 = encode(left, b2, 1.0, 0)
                length = lambda e: np.linalg.norm(e.reshape(len(e), -1), axis=1)
                for name, values in (("off", length(left)), ("off2", length(residual(left, b2, codes2)))):
                    pdf.iloc[at, pdf.columns.get_loc(name)] = values
                for name, packed in (("code", pack(codes)), ("code2", pack(codes2))):
                    for i, c in zip(at, packed, strict=True):
                        pdf.iat[i, pdf.columns.get_loc(name)] = c.tobytes()
            yield pdf

    own = clean.schema["vector"].dataType.simpleString()
    coded = keep(clean.mapInPandas(code, f"vec_id long, vector {own}, dim int, code binary, code2 binary, off double, off2 double").withColumn("uid", F.monotonically_increasing_id()), "search-coded")
    queries = coded.where(is_query)
    row_blocks, query_blocks = (max(1, -(-x.count() // size)) for x, size in ((coded, row_block), (queries, query_block)))
    block = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("dim", block(query_blocks).alias("q"), every(row_blocks).alias("r"), "uid", "vec_id", "vector", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("binary").alias("code2"), F.lit(None).cast("double").alias("off"), F.lit(None).cast("double").alias("off2"), F.lit(True).alias("asks"))
    right = coded.select("dim", every(query_blocks).alias("q"), block(row_blocks).alias("r"), "uid", "vec_id", "vector", "code", "code2", "off", "off2", F.lit(False).alias("asks"))

    def scan(key: tuple, both: pd.DataFrame) -> pd.DataFrame:
        """The best ``k`` of one block of rows for each query of one block."""
        q, c = both[both["asks"]], both[~both["asks"]]
        none = pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        if not len(q) or not len(c):
            return none
        b, b2, _ = books[int(key[0])]
        c = c.sort_values(["vec_id", "uid"], kind="stable", na_position="last")
        x, uids = as_matrix(c["vector"]), c["uid"].to_numpy()
        ids = [None if pd.isna(i) else int(i) for i in c["vec_id"]]
        _, first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)
        by_vector = np.argsort(same, kind="stable")  # rows of equal vectors side by side, smaller ids first
        begins = np.searchsorted(same[by_vector], np.arange(len(first) + 1))
        codes, codes2 = (unpack(np.frombuffer(b"".join(c[name]), np.uint8).reshape(len(c), -1)[first]) for name in ("code", "code2"))
        off, off2 = (c[name].to_numpy()[first] + SLACK for name in ("off", "off2"))
        y, asked = as_matrix(q["vector"]), [None if pd.isna(i) else int(i) for i in q["vec_id"]]
        tables, tables2 = (np.einsum("qpi,pki->qpk", parts(unit(y)), book).astype(np.float32) for book in (b, b2))
        n = min(max(rerank, k + 1), len(first))
        last = min(k + 1, n)  # one of them may be the query itself
        out = []
        for s in range(0, len(q), 64):
            t = tables[s : s + 64]
            approx = np.zeros((len(t), len(first)), np.float32)
            for p in range(t.shape[1]):
                approx += t[:, p][:, codes[:, p]]
            best = np.argpartition(-approx, n - 1, axis=1)[:, :n]
            exact = cosine(y[s : s + 64][:, None, :], x[first[best]])
            bound = approx + off
            np.put_along_axis(bound, best, -np.inf, axis=1)
            for i in range(len(t)):
                at, scored = best[i], exact[i]
                least = np.partition(scored, -last)[-last]
                rest = np.flatnonzero(bound[i] >= least)
                closer = approx[i][rest] + sums(tables2[s + i], codes2[rest]) + off2[rest]
                order = np.argsort(-closer, kind="stable")
                rest, closer = rest[order], closer[order]
                for start in range(0, len(rest), n):
                    more = rest[start : start + n][closer[start : start + n] >= least]
                    if not len(more):
                        break
                    at, scored = np.concatenate([at, more]), np.concatenate([scored, cosine(y[s + i], x[first[more]])])
                    least = np.partition(scored, -last)[-last]
                found = []
                for j in np.flatnonzero(scored >= least):  # at least k + 1 distinct vectors, and all that tie with the last
                    v = at[j]
                    group = by_vector[begins[v] : min(begins[v + 1], begins[v] + k + 1)]
                    found += [(-scored[j], ids[g] is None, ids[g] or 0, uids[g], ids[g]) for g in group]
                me = q["uid"].iloc[s + i]
                found = sorted(f[:4] + (f[4] is not None,) for f in found if f[3] != me)[:k]
                out += [(me, asked[s + i], f[2] if f[4] else None, -f[0]) for f in found]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"]).astype({"query_id": "Int64", "vec_id": "Int64"}) if out else none

    keys = ("dim", "q", "r")
    found = left.unionByName(right).groupBy(*keys).applyInPandas(scan, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_anisotropic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)

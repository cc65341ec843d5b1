"""Which rows of a vector table take part, and exact nearness."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, not all zeros, and every component there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_matrix(rows) -> np.ndarray:
    return np.array([np.asarray(r, dtype=np.float64) for r in rows])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no over- or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot = np.einsum("...i,...i->...", x, y)
    return dot / np.sqrt(np.einsum("...i,...i->...", x, x) * np.einsum("...i,...i->...", y, y))


def sample_of(rows: DataFrame, key: str, size: int) -> DataFrame:
    """The first ``size`` rows in the order of a hash of ``key``."""
    return rows.orderBy(F.xxhash64(key), key).limit(size)

"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<double>) of rows that can have a cosine.

    Left out: a null id; a vector that is null, empty, zero or holds null or
    non-finite components. Vectors of different lengths have no cosine with each other.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(finite & F.exists("x", lambda c: c != 0))


def lengths(rows: DataFrame) -> dict[int, int]:
    """Rows of each length of ``x``: tables hold few lengths."""
    return {r["d"]: r["count"] for r in sorted(rows.groupBy(F.size("x").alias("d")).count().collect())}


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of arrays of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    if not len(x):
        return x
    x = scaled(x)
    return x / np.sqrt(np.sum(x * x, axis=1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: exact, and no square runs over or under."""
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    # two steps, as one power may itself run over
    return np.ldexp(np.ldexp(x, -power // 2), -power - -power // 2)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows in double precision, summed in one order wherever they are computed, so that copies tie."""
    if not len(a):
        return np.empty(0)
    a, b = scaled(a), scaled(b)
    return np.sum(a * b, axis=1) / (np.sqrt(np.sum(a * a, axis=1)) * np.sqrt(np.sum(b * b, axis=1)))


def packed(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x, np.float64)], pa.binary())


def unpacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def sample(rows: DataFrame, n: int, column: str = "vec_id") -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of ``n`` rows at most, all of one length, the first by a hash of the vector."""
    got = rows.orderBy(F.xxhash64("x"), column, "x").limit(n).select(column, "x").toArrow()
    if not got.num_rows:
        return np.empty(0, np.int64), np.empty((0, 0))
    return got[column].to_numpy(), matrix(got["x"].combine_chunks())

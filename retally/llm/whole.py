"""Vectors of whole numbers, for operators that score by integer inner products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows, and asking rows, of one block of a grid; only memory and traffic depend on them.
ROWS, ASKS = 8192, 8192


def scaled(vectors: DataFrame, by: int, *also: str) -> DataFrame:
    """``(vec_id, *also, v)``: every component x of ``embedding`` as floor(by * x), x in double precision.

    Rows with a null id, a null or empty vector, a null or non-finite component or a null in ``also`` are left out.  Rows that
    share an id count once (where they differ, the least row).
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *also, x.alias("embedding"))
    for column in ("vec_id", "embedding", *also):
        rows = rows.where(F.col(column).isNotNull())
    rows = rows.where(F.size("embedding") > 0).where(fine).select("vec_id", F.struct(*also, F.transform("embedding", lambda e: F.floor(e * by)).alias("v")).alias("r"))
    return rows.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.*")


def exact(rows: DataFrame) -> bool:
    """Whether products of the vectors ``v`` are exact in double precision; raises where 64 bits do not hold them."""
    most, size = rows.agg(F.max(F.array_max(F.transform("v", lambda e: F.abs(e)))), F.max(F.size("v"))).first()
    bound = (most or 0) ** 2 * (size or 0)
    if bound >= 1 << 62:
        raise ValueError(f"components up to {most} in {size} dimensions: inner products may not fit 64 bits")
    return bound < 1 << 52


def matrix(column: pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix."""
    values = column.combine_chunks()
    return np.asarray(values.flatten(), kind).reshape(len(values), -1)


def products(x: np.ndarray, q: np.ndarray, doubles: bool) -> np.ndarray:
    """Integer inner products of rows with one vector."""
    return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64) if doubles else x @ q


def table_products(q: np.ndarray, x: np.ndarray, doubles: bool) -> np.ndarray:
    """Integer inner products of several vectors (lines) with rows (columns); in double precision where that is exact."""
    kind = np.float64 if doubles else np.int64
    return q.astype(kind, copy=False) @ x.astype(kind, copy=False).T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def splits(count: int, size: int) -> int:
    return max(1, -(-count // size))

"""Vectors as distinct classes, so that any number of copies of a vector costs one row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, has only finite components, and is not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1, scaled first so that no square is too large or too small."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in doubles and always summed in one order."""
    left = left / np.abs(left).max(axis=1, keepdims=True)
    right = right / np.abs(right).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", left, right)
    return dot / np.sqrt(np.einsum("ij,ij->i", left, left)) / np.sqrt(np.einsum("ij,ij->i", right, right))


def one_length(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vectors have the most frequent length, the shorter of equally frequent ones."""
    lengths = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size(vector) == (lengths["d"] if lengths else 0))

"""Embedding vectors as whole numbers: which rows take part, and their exact products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components beyond this size could overflow a 64-bit sum of products; they raise an error.
LARGEST = 1 << 26


def is_whole(vector: Column) -> Column:
    """True where a vector is there and none of its components is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """Components as ``floor(scale * x)``, x taken as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column whose lists all have ``width`` whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return checked(values.reshape(len(column), width))


def checked(matrix: np.ndarray) -> np.ndarray:
    """``matrix``, or an error if its products could leave 64 bits."""
    if matrix.size and max(int(matrix.max()), -int(matrix.min())) > LARGEST:
        raise ValueError(f"a scaled component lies beyond {LARGEST}")
    return matrix


def products(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows with a vector; by floating point where that is exact."""
    if matrix.size:
        largest = float(np.abs(matrix).max()) * float(np.abs(vector).max(initial=0)) * matrix.shape[1]
        if largest < 2.0**53:
            return (matrix.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    return matrix @ vector

"""Helpers of the vector operators: which vectors take part, integer components, Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: up to this sum of squares 64-bit arithmetic on differences of components stays exact
EXACT = 2.0**52


def usable(vector: Column) -> Column:
    """True for vectors that are neither NULL nor empty nor hold a NULL or non-finite component."""
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def floors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def dimension(vectors: DataFrame, vector_col: str) -> int | None:
    """The greatest dimension of the vectors; None if there are none. Operators on one space leave shorter vectors out."""
    return vectors.agg(F.max(F.size(vector_col)).alias("d")).first().d


def matrix(column: pa.Array, dim: int, dtype=np.int64) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix (flatten() heeds the offsets of a slice)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), dim)


def slices(batches, rows: int = 4096):
    """Arrow batches in slices of at most ``rows`` rows."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def fits(*arrays: np.ndarray) -> bool:
    """Whether squared distances between rows of the arrays stay exact in doubles and longs."""
    dim = max(1, arrays[0].shape[-1])
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    return dim * (2.0 * top) ** 2 < EXACT

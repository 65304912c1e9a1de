"""Columns of vectors: which take part, and their way into numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not zero, and without missing or non-finite components."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_id(vector: Column) -> list[Column]:
    """Two 64-bit hashes that together name the contents of a vector."""
    return [
        F.xxhash64(vector).alias("vector_a"),
        F.xxhash64(F.lit("second"), vector).alias("vector_b"),
    ]


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, len(values) // n if n else 0)

"""Vectors of a table as integer matrices inside Arrow batches, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Scaled entries beyond this size count as this size, so that sums of products stay within 38 digits.
LARGEST = 1 << 50


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors of ``df`` have, the larger one on a tie; 0 without vectors."""
    sizes = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return first[0]["size"] if first else 0


def integer_rows(column: pa.Array, length: int, scale: int, shift: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors in ``column`` and their ``floor(scale * c) + shift`` as an int64 matrix.

    Null vectors, vectors with null or non-finite entries and vectors of another length are not usable.
    """
    starts = column.offsets.to_numpy()
    fits = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(starts) == length)
    at = np.flatnonzero(fits)
    values = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    if not len(at) or not length:
        return at[:0], np.empty((0, length), np.int64)
    found = values[starts[at][:, None] + np.arange(length)]
    finite = np.isfinite(found).all(axis=1)
    scaled = np.clip(np.floor(found[finite] * float(scale)), -LARGEST, LARGEST)
    return at[finite], scaled.astype(np.int64) + shift

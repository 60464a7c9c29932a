"""Small helpers for vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """True where a vector is there, has components, and all of them are finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Equal-length list column -> matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0), dtype)


def pick(df: DataFrame, key: str, vector: str, n: int) -> list:
    """A bounded, deterministic sample: the ``n`` rows with the smallest hashes."""
    return [r[0] for r in df.orderBy(F.xxhash64(vector), key).limit(n).select(vector).collect()]

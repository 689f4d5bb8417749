"""Vector columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """The vector is there and every component is a finite number."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    """Rows of a list column, shorter ones padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    at = 0
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at: at + n]
        at += n
    return out

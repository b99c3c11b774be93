"""Columns of vectors: which rows are usable, and their entries as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    v = F.col(column)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def longest(vectors: DataFrame, column: str) -> int:
    """Entries of the longest vector; shorter ones count as ending in zeros."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Usable vectors as rows of doubles."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(len(lengths), size)
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out = np.zeros((len(lengths), size))
    out[owner, np.arange(len(flat)) - begins[owner]] = flat
    return out

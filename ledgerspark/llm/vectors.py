"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not zero, and every component a finite number."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The components of all vectors in one array, and the length of each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lengths


def by_length(column: pa.Array):
    """For each length: which rows have it, and these rows as a matrix in double precision."""
    flat, lengths = rows_of(column)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        which = np.flatnonzero(lengths == n)
        yield int(n), which, flat[starts[which][:, None] + np.arange(n)]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def lengths_of(df: DataFrame, vector: str) -> list[int]:
    """The distinct vector lengths of the frame."""
    return sorted(r[0] for r in df.select(F.size(vector)).distinct().collect())

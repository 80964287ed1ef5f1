"""Embedding columns as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, first, length) of a column of lists as float64; null lists have length 0 and null elements are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    values = pc.fill_null(pc.cast(pc.list_flatten(column), pa.float64()), float("nan"))
    return np.asarray(values), np.cumsum(length) - length, length


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of the column's lists, of those that hold finite numbers only and one at least."""
    values, first, length = lists(column)
    out = []
    for d in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == d)
        own = values[first[rows][:, None] + np.arange(d)]
        fine = np.isfinite(own).all(axis=1)
        out.append((rows[fine], own[fine]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of x (none zero) scaled to length one; first by their largest component, so that squares stay in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

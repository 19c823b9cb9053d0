"""Vectors out of Arrow list columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_vectors(column: pa.Array, most: float = np.inf) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of the column's vectors: the rows and their vectors as a
    matrix of doubles, without the rows whose vector is null or empty or holds a null, a
    non-finite entry or one of magnitude most or more."""
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)   # a null becomes NaN
    starts = np.cumsum(lens) - lens
    for n in np.unique(lens[lens > 0]):
        rows = np.flatnonzero(lens == n)
        matrix = values[starts[rows][:, None] + np.arange(n)]
        ok = (np.abs(matrix) < most).all(1)   # false for NaN
        yield rows[ok], matrix[ok]

"""Vectors of Arrow list columns as NumPy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length that occurs, the numbers of the rows that hold a vector
    of it and these vectors in double precision. Null and empty vectors and
    those with null or non-finite entries are left out."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    filled = np.maximum(length, 0)
    start = np.cumsum(filled) - filled
    for n in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == n)
        found = values[start[rows][:, None] + np.arange(n)]
        whole = np.isfinite(found).all(axis=1)
        yield rows[whole], found[whole]

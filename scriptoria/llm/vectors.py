"""Vector columns as matrices, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length among the vectors of a batch: only vectors that are not null or empty
    and whose components are all finite (a null component counts as not finite)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    edges = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(edges)
    if column.null_count:
        size = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, size)
    for k in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == k)
        found = flat[edges[rows][:, None] + np.arange(k)]
        fine = np.isfinite(found).all(axis=1)
        if fine.any():
            yield rows[fine], found[fine]


def packed_rows(matrix: np.ndarray) -> list[bytes]:
    """The bytes of each row."""
    width = matrix.shape[1] * matrix.itemsize
    data = np.ascontiguousarray(matrix).tobytes()
    return [data[lo : lo + width] for lo in range(0, len(data), width)]

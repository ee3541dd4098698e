"""What the operators of this subpackage share: Arrow batches; tables stored between steps are the library's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from docketspark.plans.stored import fresh, partitions, removed, scratch, shared_folder, with_group, written

__all__ = ["fresh", "partitions", "pieces", "removed", "scratch", "shared_folder", "sliced", "text_bytes", "with_group", "written"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the len+1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(raw: np.ndarray, at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts the rows of a batch into runs of about `most` bytes, whole rows only: (first row, end row, bytes, offsets)."""
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of about `most` bytes of the text column, one row at least, so that arrays of a task stay small."""
    for batch in batches:
        at = text_bytes(batch.column(column))[1]
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j

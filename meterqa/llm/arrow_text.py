"""Bytes of a text column in runs of rows, for tasks that work with arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that an array step holds at once; a longer text is a run of its own.
RUN_BYTES = 1 << 20


def text_runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, UTF-8 bytes) of successive runs; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, ends, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and offsets[-1] else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        after = min(after, len(column))
        yield first, after, offsets[first : after + 1] - offsets[first], whole[offsets[first] : offsets[after]]
        first = after

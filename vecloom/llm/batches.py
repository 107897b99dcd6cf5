"""Text columns of Arrow batches in slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def bounded(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices whose ``column`` holds at most ``max_bytes``, or one row.

    At the end of a task's rows its freed memory goes back to the machine: worker processes
    serve the tasks of many stages, and a later one should not start from an earlier one's peak.
    """
    for batch in batches:
        _, ends = text_buffer(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop
    release_memory()


def release_memory() -> None:
    """Gives what Arrow and the allocator hold but do not use back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each row begins and the last one ends. Null rows are empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def spans(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i]`` to ``starts[i] + lengths[i]`` of every i, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift

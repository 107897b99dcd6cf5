"""Arrow functions over slices of bounded size.

Spark hands a function up to 10,000 rows at a time, whatever they hold. What a function builds
beside its rows (masks, indices, dense matrices) is built for one slice here, and a slice's
result is handed on before the next one is looked at.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A slice holds so many bytes and rows at most, or one row.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024


def _places(rows: pa.Array) -> np.ndarray:
    """Where each row begins among the bytes of all, and where the last one ends."""
    kind = rows.type
    if not len(rows):
        return np.zeros(1, np.int64)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return _places(rows.values)[rows.offsets.to_numpy()]
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        width = np.int64 if pa.types.is_large_string(kind) else np.int32
        return np.frombuffer(rows.buffers()[1], width)[rows.offset : rows.offset + len(rows) + 1]
    return np.arange(len(rows) + 1) * (kind.bit_width // 8)


def slices(rows: pa.Array, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """``rows`` (texts, numbers or lists of them) in order, in slices of at most ``max_bytes`` and ``max_rows``, or one row."""
    places, start = _places(rows), 0
    while start < len(rows):
        stop = int(np.searchsorted(places, int(places[start]) + max_bytes, side="right")) - 1
        stop = max(start + 1, min(stop, start + max_rows, len(rows)))
        yield rows.slice(start, stop - start)
        start = stop


def release_memory() -> None:
    """Gives what Arrow and the allocator hold but do not use back to the machine: workers serve the tasks of many stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_slices(function: Callable[[pa.Array], pa.Array], kind: T.DataType, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS) -> Callable[[Column], Column]:
    """An Arrow function of one column that calls ``function`` with one slice of rows at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in slices(batch, max_bytes, max_rows):
                yield function(part)
        release_memory()

    run.__name__ = function.__name__
    return F.arrow_udf(run, kind)

"""Overlapping word windows with character offsets.

A batch of texts is looked at as one buffer of UTF-8: where words begin and end is found for
all of them at once, and a window is a slice between two such places. Nothing is split into
strings, so a text of any length takes time in proportion to it. What is held beside a batch is
a few bytes for every byte of one slice of it.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import types as T

from vecloom.functions.slices import in_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: white space as Python's str.split and str.strip see it.
WHITE_SPACE = "".join(chr(c) for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
WINDOW = T.StructType(
    [
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("total_chunks", T.IntegerType()),
        T.StructField("chunk_content", T.StringType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("start_char", T.IntegerType()),
    ]
)
_KINDS = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32())


def check_window(size: int, overlap: int) -> None:
    if overlap >= size:
        raise ValueError(f"overlap ({overlap}) must be smaller than size ({size})")


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 and where each begins and the last one ends; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def _blank(data: np.ndarray) -> np.ndarray:
    """Which bytes are of white space. A character of several bytes is looked for by its last one."""
    single = np.zeros(256, bool)
    single[[ord(c) for c in WHITE_SPACE if ord(c) < 128]] = True
    out = single[data]
    for character in (c.encode() for c in WHITE_SPACE if ord(c) >= 128):
        at = np.flatnonzero(data[len(character) - 1 :] == character[-1])
        for k, byte in enumerate(character[:-1]):
            at = at[data[at + k] == byte]
        for k in range(len(character)):
            out[at + k] = True
    return out


def _rows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place within it of ``counts[row]`` things each."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _characters_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Characters before each of the sorted ``places``: bytes that begin one."""
    if not (len(data) and len(places)):
        return np.zeros(len(places), np.int64)
    firsts = (data & 0xC0) != 0x80
    inner = places[places < len(data)]
    sums = np.add.reduceat(firsts, np.concatenate(([0], inner)), dtype=np.int64)
    # a place that follows itself sums its one byte instead of none
    sums[:-1][np.diff(inner, prepend=0) == 0] = 0
    return np.concatenate((np.cumsum(sums[:-1]), np.full(len(places) - len(inner), sums.sum())))


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``data[begin[i]:end[i]]`` of every i, one after the other."""
    return np.concatenate([np.empty(0, np.uint8), *[data[a:b] for a, b in zip(begin.tolist(), end.tolist())]])


def windows_of(texts: pa.Array, size: int, overlap: int) -> pa.Array:
    """Lists of WINDOW for each text."""
    data, ends = _text_bytes(texts)
    blank = _blank(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    starts = np.flatnonzero(~blank & (np.concatenate(([True], blank[:-1])) | edge[:-1])) if len(data) else np.empty(0, np.int64)
    stops = np.flatnonzero(~blank & (np.concatenate((blank[1:], [True])) | edge[1:])) + 1 if len(data) else starts
    first_word = np.searchsorted(starts, ends)
    words = np.diff(first_word)
    step = size - overlap
    count = np.where(words == 0, 0, np.where(words <= size, 1, 1 - (size - words) // step))
    row, k = _rows(count)
    first = first_word[row] + k * step
    tokens = np.minimum(size, words[row] - k * step)
    begin, end = starts[first], stops[first + tokens - 1]
    start_char = np.where(count[row] == 1, 0, _characters_before(data, begin) - _characters_before(data, ends)[row])
    offsets = np.concatenate(([0], np.cumsum(end - begin)))
    wide = offsets[-1] > np.iinfo(np.int32).max
    kind = pa.large_string() if wide else pa.string()
    contents = pa.Array.from_buffers(kind, len(row), [None, pa.py_buffer(offsets.astype(np.int64 if wide else np.int32)), pa.py_buffer(_joined(data, begin, end))])
    columns = [pa.array(x.astype(np.int32)) for x in (k, count[row], tokens, start_char)]
    columns.insert(2, contents)
    fields = [pa.field(n, contents.type if n == "chunk_content" else kind) for n, kind in zip(WINDOW.names, _KINDS, strict=True)]
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), pa.StructArray.from_arrays(columns, fields=fields))


def word_windows(text: Column, size: int = 256, overlap: int = 32) -> Column:
    """Array of (chunk_index, total_chunks, chunk_content, token_count, start_char).

    Window k has the words from k*step on; it is the text from its first word's beginning to
    its last word's end, and ``start_char`` says where that is. A text of up to ``size`` words
    is one window that starts at 0; one without words has none, null as well. ``text`` is a
    column or an expression without lambdas.
    """
    check_window(size, overlap)

    def windows(texts: pa.Array) -> pa.Array:
        return windows_of(texts, size, overlap)

    return in_slices(windows, T.ArrayType(WINDOW))(text)

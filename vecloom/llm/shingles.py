"""Word shingles of whole texts as sorted 64-bit digests, computed for a slice of rows at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vecloom.llm.batches import text_buffer

SLICE_BYTES = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_bytes = np.arange(256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SUMS = np.array([1, _STEP, 1], np.uint64)
_powers = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _FACTOR
    return x ^ (x >> np.uint64(32))


# One random-looking number per byte; a capital A-Z has that of its small letter.
_LETTERS = mixed(np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint64) * _STEP + np.uint64(1))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        size = max(n, 2 * len(_powers), 64)
        _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _STEP, np.uint64))), dtype=np.uint64)
    return _powers


def word_digests(column: pa.Array, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all words in order, and where each row's words begin and the last one's end. ``separator`` marks the bytes between words."""
    data, ends = text_buffer(column)
    visible = ~separator[data]
    start = visible.copy()
    start[1:] &= ~visible[:-1]
    rows = ends[:-1][ends[:-1] < ends[1:]]
    start[rows] = visible[rows]
    at = np.flatnonzero(visible)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    begins = np.flatnonzero(start[at])
    lengths = np.diff(np.append(begins, len(at)))
    place = np.arange(len(at)) - np.repeat(begins, lengths)
    digests = np.add.reduceat(_LETTERS[data[at]] * _powers_to(int(lengths.max()))[place], begins)
    return mixed(digests), np.searchsorted(at[begins], ends)


def _fold(words: np.ndarray, k: int) -> np.ndarray:
    found = np.full(len(words) - k + 1, np.uint64(k))
    for j in range(k):
        found = found * _FACTOR + words[j : len(words) - k + 1 + j]
    return mixed(found)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Per row its distinct k-word shingles, sorted; all words as one where there are fewer; none without words."""
    words, bounds = word_digests(column)
    grams = _fold(words, k) if len(words) >= k else words[:0]
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= k:
            found = np.sort(grams[a : b - k + 1])
            out.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        else:
            out.append(_fold(words[a:b], b - a) if b > a else grams[:0])
    return out


def set_digest(found: np.ndarray) -> int:
    """One signed 64-bit digest of a set."""
    sums = np.array([found.sum(dtype=np.uint64), mixed(found).sum(dtype=np.uint64), len(found)], np.uint64)
    return int(mixed((sums * _SUMS).sum(keepdims=True, dtype=np.uint64)).astype(np.int64)[0])

"""SimHash and MinHash of one row's tokens, on whole Arrow batches.

A batch hashes and permutes each distinct token once; a row's sketch is then a sum or a minimum over its
own tokens. Nothing leaves the row, so rows of equal id stay apart and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import types as T

from vecloom.functions.slices import in_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: modulus of the MinHash permutations, 2**32 + 15.
PRIME = 4294967311
# Tokens handled at once: bounds the memory of a batch whatever its rows hold.
AT_ONCE = 1 << 13


def permutations(count: int = 64, seed: int = 42) -> list[tuple[int, int]]:
    """(a, b) of h -> (a*h + b) mod PRIME. Fixed: the order in which the numbers are drawn."""
    rng = random.Random(seed)
    a = [rng.randint(1, PRIME - 1) for _ in range(count)]
    b = [rng.randint(0, PRIME - 1) for _ in range(count)]
    return list(zip(a, b))


def permuted(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(a*h + b) mod PRIME of every h and permutation; h < 2**32. As 2**32 is -15 modulo PRIME, high halves are folded, never divided."""
    h, a, b = h[:, None].astype(np.int64), a.astype(np.int64), b.astype(np.int64)
    low = np.int64(0xFFFFFFFF)
    part = a * (h >> 16)  # < 2**49
    part = (part & low) - 15 * (part >> 32)  # > -2**21
    total = (part << 16) + a * (h & 0xFFFF) + b  # > -2**37, < 2**50
    rest = (total & low) - 15 * (total >> 32)  # > -PRIME, < 2 * PRIME
    rest += PRIME * (rest < 0)
    rest -= PRIME * (rest >= PRIME)
    return rest


def _digests(tokens: pa.Array, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each distinct token, from its first md5 digits, and each token's place among them."""
    coded = tokens.fill_null("").dictionary_encode()
    width = digits // 2
    found = b"".join([hashlib.md5(t).digest()[:width] for t in coded.dictionary.cast(pa.binary()).to_pylist()])
    return np.frombuffer(found, f">u{width}").astype(np.uint64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _runs(lengths: np.ndarray):
    """(first row, last row, first token, last token) of runs of rows with about AT_ONCE tokens; a longer row is cut."""
    ends = np.cumsum(lengths)
    row = 0
    while row < len(lengths):
        start = int(ends[row] - lengths[row])
        stop = max(row + 1, int(np.searchsorted(ends, start + AT_ONCE, side="right")))
        for at in range(start, max(int(ends[stop - 1]), start + 1), AT_ONCE) if stop == row + 1 else (start,):
            yield row, stop, at, int(ends[stop - 1]) if stop > row + 1 else min(at + AT_ONCE, int(ends[row]))
        row = stop


def _reduced(batch: pa.Array, reduce_: np.ufunc, values, width: int, empty: int, dtype) -> np.ndarray:
    """``reduce_`` over each row's tokens of ``values(token places)``, ``width`` numbers to a row."""
    lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(batch), width), empty, dtype)
    ends = np.cumsum(lengths)
    for row, stop, start, end in _runs(lengths):
        if end <= start:
            continue
        begins = np.maximum(ends[row:stop] - lengths[row:stop], start) - start
        some = np.flatnonzero(lengths[row:stop])
        part = reduce_.reduceat(values(start, end), begins[some], axis=0)
        out[row + some] = reduce_(out[row + some], part.astype(dtype))
    return out


def simhash_of(tokens: Column, bit_length: int = 64) -> Column:
    """Bit i is set iff more token hashes have it set than clear; 0 without tokens."""
    if not 1 <= bit_length <= 64:
        raise ValueError(f"bit_length must be 1 to 64, not {bit_length}")

    def sketch(batch: pa.Array) -> pa.Array:
        digests, place = _digests(batch.flatten(), 16)
        bits = np.unpackbits(digests.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :bit_length]
        votes = bits.astype(np.int8) * 2 - 1
        total = _reduced(batch, np.add, lambda a, b: votes[place[a:b]].astype(np.int32), bit_length, 0, np.int64)
        weights = np.uint64(1) << np.arange(bit_length, dtype=np.uint64)
        return pa.array(((total > 0) * weights).sum(axis=1, dtype=np.uint64).astype(np.int64))

    return in_slices(sketch, T.LongType())(tokens)


def minhash_of(tokens: Column, num_perm: int = 64, seed: int = 42) -> Column:
    """Per permutation the smallest value over the token set; zeros without tokens."""
    pairs = permutations(num_perm, seed)

    def sketch(batch: pa.Array) -> pa.Array:
        a, b = (np.array(x, np.int64) for x in zip(*pairs))
        digests, place = _digests(batch.flatten(), 8)
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, runs = np.cumsum(lengths), []
        for row, stop, start, end in _runs(lengths):
            if end > start:
                some = np.flatnonzero(lengths[row:stop]) + row
                runs.append((some, np.maximum(ends[some] - lengths[some], start) - start, place[start:end]))
        nothing = np.iinfo(np.int64).max
        least = np.full((num_perm, len(batch)), nothing)
        for k, found in enumerate(least):
            values = permuted(digests, a[k : k + 1], b[k : k + 1])[:, 0]
            for some, begins, tokens in runs:
                found[some] = np.minimum(found[some], np.minimum.reduceat(values[tokens], begins))
        least[least == nothing] = 0
        return pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * num_perm, pa.int32()), pa.array(least.T.ravel()))

    return in_slices(sketch, T.ArrayType(T.LongType()))(tokens)

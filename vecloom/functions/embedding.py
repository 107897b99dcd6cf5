"""Hashed bag-of-words embedding.

Row-local: a JVM form would explode every word and shuffle (chunk, slot) sums, so
the words of an Arrow batch are hashed once per distinct word and scattered into a
dense matrix instead.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import types as T

from vecloom.functions.slices import in_slices

try:  # the plain implementation starts faster per short word
    from _md5 import md5
except ImportError:
    from hashlib import md5

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Weight of a text's word and character count in slots 0 and 1.
WORD_WEIGHT = 0.1
CHAR_WEIGHT = 0.01
EPSILON = 1e-12


def _weights(texts: list[str], dim: int) -> np.ndarray:
    words = pc.split_pattern(pa.array([" ".join(t.lower().split()) for t in texts], pa.string()), " ")
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = words.flatten().dictionary_encode()
    vocabulary = encoded.dictionary.to_pylist()
    digests = b"".join([md5(w.encode()).digest()[:4] for w in vocabulary])
    hashes = np.frombuffer(digests, ">u4").astype(np.int64)
    sign = np.where((hashes >> 3) & 1, 1.0, -1.0)
    sign[[i for i, w in enumerate(vocabulary) if not w]] = 0.0  # a text without words splits into one empty word
    codes = encoded.indices.to_numpy()
    rows = np.repeat(np.arange(len(texts)) * dim, counts)
    dense = np.bincount(rows + (hashes % dim)[codes], weights=sign[codes], minlength=len(texts) * dim)
    dense = dense.reshape(len(texts), dim)
    real_words = np.bincount(rows // dim, weights=np.abs(sign)[codes], minlength=len(texts))
    dense[:, 0] += WORD_WEIGHT * real_words
    dense[:, 1] += CHAR_WEIGHT * np.array([len(t) for t in texts], dtype=np.float64)
    return dense


def hashed_embedding(text: Column, dim: int = 384, normalize: bool = True) -> Column:
    """Dense ``array<float>`` of ``dim`` slots; null and empty texts give zeros."""

    def embed(batch: pa.Array) -> pa.Array:
        texts = [t or "" for t in batch.to_pylist()]
        dense = _weights(texts, dim) if texts else np.zeros((0, dim))
        if normalize:
            dense /= np.maximum(np.sqrt((dense * dense).sum(axis=1, keepdims=True)), EPSILON)
        offsets = np.arange(0, dense.size + 1, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(dense.astype(np.float32).ravel()))

    return in_slices(embed, T.ArrayType(T.FloatType()))(text)

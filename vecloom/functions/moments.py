"""Mergeable moments: each task folds its batches into one small state, states are merged pairwise.

Sums are taken around the mean of what was seen so far, and merging adds the shift between two
means, so values far from zero lose nothing by cancellation.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Large states are merged by so many tasks first, then by one.
MERGING_TASKS = 8


@dataclass
class VectorMoments:
    """Count, mean and scatter matrix of the longest vectors seen; shorter ones are not counted."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, vectors: pa.Array) -> VectorMoments | None:
        lengths = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        longest = int(lengths.max()) if len(lengths) else 0
        if not longest:
            return None
        x = vectors.filter(pa.array(lengths == longest)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, longest)
        mean = x.mean(axis=0)
        x = x - mean
        return cls(len(x), mean, x.T @ x)

    def merged(self, other: VectorMoments) -> VectorMoments:
        if len(self.mean) != len(other.mean):
            return self if len(self.mean) > len(other.mean) else other
        n, shift = self.n + other.n, other.mean - self.mean
        return VectorMoments(n, self.mean + shift * (other.n / n), self.scatter + other.scatter + np.outer(shift, shift) * (self.n * other.n / n))


@dataclass
class PairMoments:
    """Error and product sums of pairs of values, and the spread of the first ones."""

    n: int
    mean: float
    spread: float
    squared_error: float
    largest_error: float
    dot: float
    xx: float
    yy: float

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> PairMoments | None:
        if not len(x):
            return None
        error, mean = x - y, float(x.mean())
        return cls(len(x), mean, float(((x - mean) ** 2).sum()), float(error @ error), float(np.abs(error).max()), float(x @ y), float(x @ x), float(y @ y))

    def merged(self, other: PairMoments) -> PairMoments:
        n, shift = self.n + other.n, other.mean - self.mean
        spread = self.spread + other.spread + shift * shift * self.n * other.n / n
        sums = (self.squared_error + other.squared_error, max(self.largest_error, other.largest_error), self.dot + other.dot, self.xx + other.xx, self.yy + other.yy)
        return PairMoments(n, self.mean + shift * other.n / n, spread, *sums)


def folded(df: DataFrame, kind: type, of_batch: Callable[[pa.RecordBatch], Any], tasks: int = MERGING_TASKS) -> DataFrame:
    """One row with the fields of the ``kind`` of state that all rows have, pickled, or none; one scan, lazily.

    A task holds two states at a time. ``tasks`` merge first, before one task merges theirs; 0
    leaves that out, for states of a few bytes.
    """

    def states(found: Iterator[Any]) -> Iterator[pa.RecordBatch]:
        total = None
        for state in found:
            if state is not None:
                total = state if total is None else total.merged(state)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(total))], pa.binary())], names=["state"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return states(of_batch(batch) for batch in batches)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return states(kind(**pickle.loads(s)) for batch in batches for s in batch.column("state").to_pylist())

    some = df.mapInArrow(first, "state binary")
    some = some.repartition(tasks).mapInArrow(again, "state binary") if tasks else some
    return some.repartition(1).mapInArrow(again, "state binary")

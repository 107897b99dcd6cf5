"""Repartitioning and shard distribution."""

from __future__ import annotations

import pickle
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.moments import folded
from vecloom.functions.quantiles import KeySketch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_RANGE = 1 << 17


def partition_by_hash(df: DataFrame, key: str, partitions: int = 16) -> DataFrame:
    return df.repartition(partitions, F.col(key))


def partition_by_range(df: DataFrame, key: str | tuple[str, ...], partitions: int | None = 16) -> DataFrame:
    """Ranges of ``key``; without a number, the session's shuffle width, which AQE fits to the size."""
    columns = [F.col(c) for c in ((key,) if isinstance(key, str) else key)]
    return df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)


def partition_by_sketch(df: DataFrame, key: tuple[str, ...], rows_per_range: int = ROWS_PER_RANGE, keys: DataFrame | None = None) -> DataFrame:
    """Ranges of ``key`` of about ``rows_per_range`` rows, each one partition and sorted.

    The bounds come from one pass over the key columns, in which every task makes a sketch
    of a few thousand keys; sketches are merged by the executors. ``keys`` may give the same
    keys from an earlier step, so that what is costly in ``df`` is computed once only; rows
    are neither stored nor sampled. A single key that outgrows a range stays in one.
    """
    sketch = key_sketch(df if keys is None else keys, key)
    parts = max(1, -(-sketch.n // rows_per_range))
    return df.repartitionById(parts, place_among(df, key, sketch.bounds(parts))).sortWithinPartitions(*key)


def key_sketch(df: DataFrame, key: tuple[str, ...]) -> KeySketch:
    """The sketch of all keys: one pass over the key columns."""
    found = folded(df.select(*key), KeySketch, _sketched).first()
    return KeySketch(**pickle.loads(found["state"])) if found else KeySketch([], 0)


def place_among(df: DataFrame, key: tuple[str, ...], bounds: list[tuple]) -> Column:
    """How many of the sorted ``bounds`` are at most a row's key: every step-th bound is looked at first, then those that follow it."""
    if not bounds:
        return F.lit(0)
    kinds = [df.schema[c].dataType for c in key]
    own = F.struct(*[F.col(c) for c in key])
    listed = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(c) for v, kind, c in zip(b, kinds, key, strict=True)]) for b in bounds])
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.lit(len(bounds)), F.lit(step)), lambda i: F.get(listed, i - 1)), lambda b: b <= own))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    return start + F.size(F.filter(F.slice(listed, start + 1, F.lit(step)), lambda b: b <= own))


def _sketched(batch: pa.RecordBatch) -> KeySketch:
    columns = [c.to_pylist() for c in batch.columns]
    return KeySketch([list(zip(*columns, strict=True))], batch.num_rows).compacted()


def rebalance(df: DataFrame, key: str) -> DataFrame:
    """Group rows by key into partitions of the advisory size.

    AQE splits a key that outgrows one partition and merges small ones, so a sink with few
    shards is still written by many tasks.
    """
    return df.hint("rebalance", F.col(key))


def shard_distribution(df: DataFrame, key: str = "partition_id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("vector_count"))

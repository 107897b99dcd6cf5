"""Quantization quality, storage footprint and side-by-side dimensions."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.binding import once
from vecloom.functions.moments import PairMoments, folded

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ERRORS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("mse", "max_absolute_error", "dot", "norm_x", "norm_y", "variance")])


def _row_sums(x: pa.Array, y: pa.Array) -> pa.Array:
    """The sums of ERRORS of each pair of vectors; null where one is null, empty or of another length."""
    n, other = (pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False) for v in (x, y))
    good = (n == other) & (n > 0)
    a, b = (v.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(np.float64) for v in (x, y))
    n = n[good]
    out = np.zeros((6, len(good)))
    if len(n):
        first, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        add = np.add.reduceat
        mean = add(a, first) / n
        out[:, good] = (
            add((a - b) ** 2, first) / n, np.maximum.reduceat(np.abs(a - b), first), add(a * b, first), np.sqrt(add(a * a, first)), np.sqrt(add(b * b, first)), add((a - mean[owner]) ** 2, first) / n
        )
    return pa.StructArray.from_arrays([pa.array(column, mask=~good) for column in out], ERRORS.names)


def _pair_moments(batch: pa.RecordBatch) -> PairMoments | None:
    """Moments of all pairs of values; vectors of different lengths and null values have no pairs."""
    x, y = (batch.column(c) for c in ("x", "y"))
    n, other = (pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False) for v in (x, y))
    a, b = (v.filter(pa.array(n == other)).flatten() for v in (x, y))
    good = pc.and_(pc.is_valid(a), pc.is_valid(b))
    return PairMoments.of(*(v.filter(good).to_numpy(zero_copy_only=False).astype(np.float64) for v in (a, b)))


def _global_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for state in batch.column("state").to_pylist():
            m = PairMoments(**pickle.loads(state))
            row = (m.squared_error / m.n, m.largest_error, m.dot, m.xx**0.5, m.yy**0.5, m.spread / m.n)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=ERRORS.names)


def quantization_error(df: DataFrame, original: str, reconstructed: str, by: tuple[str, ...] = ()) -> DataFrame:
    """MSE, largest error, cosine and SNR over all values, or of every row beside its ``by`` columns.

    The form with ``by`` looks at one row at a time: nothing is shuffled, and rows of equal id
    stay apart. The other one is a single scan whose tasks hand on one state of sums each.
    """
    if by:
        # bound first: Spark does not take a function to Python whose argument holds a lambda
        pairs = once(df.select(*by, F.col(original).alias("_x"), F.col(reconstructed).alias("_y")), _pair=F.struct("_x", "_y"))
        errors = F.arrow_udf(_row_sums, ERRORS)(F.col("_pair._x"), F.col("_pair._y"))
        sums = pairs.select(*by, errors.alias("e")).select(*by, "e.*")
    else:
        pairs = df.select(F.col(original).alias("x"), F.col(reconstructed).alias("y"))
        sums = folded(pairs, PairMoments, _pair_moments, tasks=0).mapInArrow(_global_sums, ERRORS)
        # no pair at all still gives its one row, of nulls
        sums = sums.agg(*[F.max(name).alias(name) for name in ERRORS.names])
    real = (F.col("norm_x") > 1e-12) & (F.col("norm_y") > 1e-12)
    cosine = F.when(real, F.col("dot") / F.nullif(F.col("norm_x") * F.col("norm_y"), F.lit(0.0))).otherwise(F.lit(1.0))
    ratio = F.col("variance") / (F.col("mse") + 1e-12)
    # a constant vector has no variance: the logarithm of zero is minus infinity
    snr = F.when(F.col("mse") == 0, F.lit(100.0)).when(ratio > 0, 10 * F.log10(ratio)).otherwise(F.lit(float("-inf")))
    return sums.select(*by, "mse", "max_absolute_error", cosine.alias("cosine_similarity"), snr.alias("snr_db")).select(
        "*", F.greatest(F.lit(0.0), 1 - F.col("cosine_similarity")).alias("cosine_distortion")
    )


def dimension_compare(df: DataFrame, id_column: str, original: str, reconstructed: str, dims: int = 48) -> DataFrame:
    """(id, dimension, original, reconstructed) for the first ``dims`` dimensions."""
    first = F.arrays_zip(
        F.slice(F.col(original), 1, dims).alias("original"), F.slice(F.col(reconstructed), 1, dims).alias("reconstructed")
    )
    return df.select(id_column, F.posexplode(first).alias("dimension", "pair")).select(id_column, "dimension", "pair.*")


def storage_ratio(df: DataFrame, vector: str, packed: str) -> DataFrame:
    """Bytes of the 32-bit vectors and of their INT8 form, and the ratio."""
    return df.agg(
        F.sum(F.size(vector).cast("bigint") * 4).alias("fp32_bytes"), F.sum(F.length(packed).cast("bigint")).alias("int8_bytes")
    ).select("*", (F.col("fp32_bytes") / F.nullif(F.col("int8_bytes"), F.lit(0).cast("bigint"))).alias("ratio"))

"""PCA projection from one scan's moments."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.moments import VectorMoments, folded

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Projections are rounded to so many digits after the leading one of the first component's spread.
DIGITS = 11


def project_pca(
    df: DataFrame, k: int = 3, id_column: str = "id", vector_column: str = "vector"
) -> tuple[DataFrame, list[float]]:
    """(id, projection) on the first k centred components, and their explained variance ratios.

    Each component is signed so that its largest loading is positive.  With fewer rows than
    components the first values of the vector come back padded, with equal ratios. Rows
    whose vector is null, empty, or of another length than the longest are left out. Count,
    mean and scatter matrix come from one scan; the second one projects, to DIGITS digits. The
    driver holds one matrix of the vectors' dimension.
    """
    rows = df.select(F.col(id_column), F.col(vector_column).alias("vector"))
    found = folded(rows.select("vector"), VectorMoments, lambda batch: VectorMoments.of(batch.column("vector"))).first()
    moments = VectorMoments(**pickle.loads(found["state"])) if found else VectorMoments(0, np.zeros(0), np.zeros((0, 0)))
    longest = len(moments.mean)
    rows = rows.filter((F.size("vector") == F.lit(longest)) & (F.size("vector") > 0))
    if moments.n < k:
        first = F.slice("vector", 1, k)
        padded = F.slice(F.concat(first, F.array_repeat(F.lit(0.0).cast("float"), k)), 1, k)
        return rows.select(id_column, padded.cast("array<double>").alias("projection")), [1.0 / k] * k

    values, vectors = np.linalg.eigh(moments.scatter)
    components = np.zeros((longest, k))
    components[:, : min(k, longest)] = vectors[:, ::-1][:, :k]
    components *= np.where(components[np.abs(components).argmax(axis=0), range(k)] < 0, -1.0, 1.0)
    ratios = np.zeros(k)
    ratios[: min(k, longest)] = np.maximum(values[::-1][:k], 0.0) / max(np.maximum(values, 0.0).sum(), 1e-300)
    # Digits beyond these depend on the order of sums, that is on the partitions of the input.
    spread = float(np.sqrt(max(values[-1], 0.0) / moments.n))
    decimals = DIGITS - int(np.floor(np.log10(spread))) if spread > 0 else 0
    held = df.sparkSession.sparkContext.broadcast((moments.mean, components))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, onto = held.value
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, len(mean))
            out = np.round((x - mean) @ onto, decimals)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, k), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_column, "projection"])

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(projected, f"`{id_column}` {kind}, projection array<double>"), [float(r) for r in ratios]

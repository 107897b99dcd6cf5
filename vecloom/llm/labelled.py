"""Bounded samples of labelled documents, and which rows a label may be learned from."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, out: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == out, F.lit(False))


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    out: int,
    per_class: int,
    max_bytes: int,
    fit: Callable[[list[tuple[str, int]], dict[int, int]], Any],
) -> Any:
    """``fit(rows, counts)`` on texts with labels, run in one task; only the model comes to the driver.

    ``counts`` has the labelled rows of each class outside the held-out fold. At most
    ``per_class`` rows of a class are fitted on, those of smallest id hash, with texts of up to
    ``max_bytes``: that bounds the task. A document with several labels counts by the largest
    one. Nothing but text and label reaches ``fit``.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), folds, out))
    known = usable.groupBy("doc_id").agg(F.max(label).alias("_label"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.filter(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    few = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id"))
    texts = texts.filter(F.octet_length("text") <= max_bytes).dropDuplicates(["doc_id"]).select("doc_id", "text", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["doc_id"])
        model = pickle.dumps(fit([(r["text"], r["_label"]) for r in rows], counts))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = texts.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], counts)

"""Exact deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_dedup(df: DataFrame, hash_column: str = "content_hash", id_column: str = "document_id") -> DataFrame:
    """One row per hash: the row with the smallest id, null ids last.

    Lazy, and one pass: ``df`` is neither written nor computed twice. Every task first keeps
    the best row of each hash it has seen (the plan's partial group limit), so a hash that a
    third of all rows share sends one row per task; the rest is one shuffle by hash. Of rows
    that repeat both hash and id, one stays. Null is a hash like others.
    """
    place = F.row_number().over(Window.partitionBy(hash_column).orderBy(F.asc_nulls_last(id_column)))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")

"""Keyed vector collection kept as Parquet snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import cut_lineage


def latest_points(batch: DataFrame, id_column: str = "id", order_column: str = "write_order") -> DataFrame:
    """The last write of every id; combines on the map side, so a hot id stays small."""
    rest = [c for c in batch.columns if c not in (id_column, order_column)]
    last = batch.groupBy(id_column).agg(F.max_by(F.struct(*rest), F.col(order_column)).alias("point"))
    return last.select(id_column, *[F.col(f"point.{c}").alias(c) for c in rest])


def upsert(current: DataFrame | None, batch: DataFrame, id_column: str = "id", order_column: str = "write_order") -> DataFrame:
    """Collection after a batch of writes.

    The stored ids are unique already, so only those the batch rewrites are taken out; a
    small batch is broadcast for that and the collection is not shuffled.
    """
    points = latest_points(batch, id_column, order_column)
    if current is None:
        return points
    untouched = current.join(points.select(id_column), id_column, "left_anti")
    return untouched.unionByName(points)


def upsert_collection(
    spark: SparkSession,
    current_path: str | None,
    target_path: str,
    batch: DataFrame,
    id_column: str = "id",
    order_column: str = "write_order",
) -> int:
    """Write the next snapshot to ``target_path`` and return the number of rows in the batch.

    The batch is computed once: it is written first, and merged and counted from there.

    Pass no ``current_path`` to create the collection.  A snapshot is never changed in
    place: readers keep the old one until they switch.
    """
    if target_path == current_path:
        raise ValueError("a snapshot cannot overwrite the one it reads")
    current = spark.read.parquet(current_path) if current_path else None
    batch = cut_lineage(batch)
    upsert(current, batch, id_column, order_column).write.mode("errorifexists").parquet(target_path)
    return batch.count()

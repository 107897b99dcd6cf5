"""Partitioned Parquet sink and dataset summary."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.sources.footers import footer_statistics

PLAIN = ("chunk_content", "vector_fp32.list.element", "vector_int8")


def write_dataset(
    df: DataFrame,
    path: str,
    key: str = "partition_id",
    mode: str = "overwrite",
    compression: str = "snappy",
    row_group_mb: int = 64,
    plain: tuple[str, ...] = PLAIN,
) -> None:
    """One directory per shard.  Lay rows out by shard first (``rebalance`` or a repartition).

    ``plain`` columns (Parquet paths) skip the dictionary, which costs time and saves
    nothing on values that hardly repeat.
    """
    writer = df.write.mode(mode).partitionBy(key).option("compression", compression)
    writer = writer.option("parquet.block.size", row_group_mb * 1024 * 1024)
    for column in plain:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def dataset_summary(spark: SparkSession, path: str, listed: int = 10) -> DataFrame:
    """One row: total_records, file_count, schema_fields, the first files, error.

    Counts come from the files' footers, which the executors open; no row group is read.
    """
    shape = "total_records bigint, file_count bigint, schema_fields array<string>, parquet_files array<string>, error string"
    try:
        df = spark.read.parquet(path)
    except AnalysisException as missing:
        return spark.createDataFrame([(0, 0, [], [], str(missing.getCondition()))], shape)
    files = footer_statistics(spark, path).select("file", F.col("row_count").alias("rows"))
    nothing = F.lit(None).cast("string")
    counted = files.agg(F.sum("rows").alias("rows"), F.count("*").alias("files")).withColumn("file", nothing)
    first = files.orderBy("file").limit(listed).select(F.lit(0).alias("rows"), F.lit(0).alias("files"), "file")
    return counted.unionByName(first).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"),
        F.sum("files").alias("file_count"),
        F.array(*[F.lit(c) for c in df.columns]).alias("schema_fields"),
        F.sort_array(F.collect_list("file")).alias("parquet_files"),
        nothing.alias("error"),
    )

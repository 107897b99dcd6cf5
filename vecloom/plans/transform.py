"""The full transform: raw documents to sharded, quantized vector rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.binding import once
from vecloom.functions.chunks import check_window
from vecloom.functions.embedding import hashed_embedding
from vecloom.functions.hashing import sha256_hex, shard_id
from vecloom.functions.packing import quantized
from vecloom.functions.text import clean_text, nonblank, split_word_count
from vecloom.functions.vectors import l2_norm
from vecloom.operators.chunking import chunk
from vecloom.operators.dedup import exact_dedup
from vecloom.operators.partitioning import partition_by_sketch, rebalance
from vecloom.schemas import vector_payload


@dataclass(frozen=True)
class JobSettings:
    """Parameters of a run; ``dataclasses.replace`` overrides some of them."""

    input_path: str = ""
    output_path: str = ""
    max_records: int | None = None
    lowercase: bool = False
    min_words: int = 5
    deduplicate: bool = True
    chunk_size: int = 256
    chunk_overlap: int = 32
    dim: int = 384
    normalize_l2: bool = True
    quantization: str = "INT8"
    quantizer: str = "dynamic"
    clip: float = 2.5
    strategy: str = "hash"
    shards: int = 16
    partition_key: str = "partition_id"
    compression: str = "snappy"
    row_group_mb: int = 64
    staging_path: str = ""

    def __post_init__(self) -> None:
        check_window(self.chunk_size, self.chunk_overlap)
        for name, allowed in {
            "quantization": ("INT8", "FP32"),
            "quantizer": ("dynamic", "fixed"),
            "strategy": ("hash", "range"),
        }.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")


def clean_and_hash(df: DataFrame, settings: JobSettings) -> DataFrame:
    """Drop blank texts, clean, hash, count, and drop texts with too few words.

    The raw text and the timestamp end here: nothing later needs them in its shuffle.
    """
    cleaned = clean_text(F.col("content"), settings.lowercase)
    df = once(df.filter(nonblank(F.col("content"))), cleaned_content=cleaned).drop("content", "timestamp")
    return df.select(
        "*",
        sha256_hex(F.col("cleaned_content")).alias("content_hash"),
        F.length("cleaned_content").alias("char_count"),
        split_word_count(F.col("cleaned_content")).alias("word_count"),
    ).filter(F.col("word_count") >= settings.min_words)


def deduplicate(df: DataFrame, settings: JobSettings) -> DataFrame:
    return exact_dedup(df) if settings.deduplicate else df


def chunk_and_explode(df: DataFrame, settings: JobSettings) -> DataFrame:
    keep = tuple(c for c in ("source", "category", "metadata") if c in df.columns)
    return chunk(df, F.col("cleaned_content"), settings.chunk_size, settings.chunk_overlap, keep=keep)


def embed_and_normalize(df: DataFrame, settings: JobSettings) -> DataFrame:
    return once(df, vector_fp32=hashed_embedding(F.col("chunk_content"), settings.dim, settings.normalize_l2))


def quantize_and_shard(df: DataFrame, settings: JobSettings) -> DataFrame:
    """INT8 codes with the scale they use, the norm of the stored vector, and the shard."""
    vector = F.col("vector_fp32")
    if settings.quantization == "INT8":
        df = df.withColumn("coded", quantized(vector, settings.quantizer, settings.clip)).select("*", "coded.*").drop("coded")
    else:
        df = df.select(
            "*",
            F.lit(None).cast("binary").alias("vector_int8"),
            F.lit(1.0).cast("float").alias("scale_factor"),
            l2_norm(vector).cast("float").alias("l2_norm"),
        )
    return df.select("*", F.lit(0).alias("zero_point"), shard_id(F.col("chunk_id"), settings.shards).alias("partition_id"))


STAGES = (clean_and_hash, deduplicate, chunk_and_explode, embed_and_normalize, quantize_and_shard)


def transform_all(raw: DataFrame, settings: JobSettings | None = None) -> DataFrame:
    """All stages in order.  One shuffle (the deduplication); the rest is row-local."""
    settings = settings or JobSettings()
    return vector_payload_of(_chain(raw, settings))


def _chain(df: DataFrame, settings: JobSettings) -> DataFrame:
    for stage in STAGES:
        df = stage(df, settings)
    return df


def vector_payload_of(df: DataFrame) -> DataFrame:
    """``vector_payload``, with an empty map where the input carried no metadata."""
    if "metadata" not in df.columns:
        df = df.withColumn("metadata", F.lit(None).cast("map<string,string>"))
    return vector_payload(df)


def lay_out(df: DataFrame, settings: JobSettings, keys: DataFrame | None = None) -> DataFrame:
    """Arrange rows for the sink by the configured strategy.

    A range layout looks at the keys first: ``keys`` may give them from the chunk stage, before
    what is costly. Ranges go by shard and chunk: as many tasks as the data needs share a
    large shard, and every file holds an interval.
    """
    if settings.strategy == "range":
        return partition_by_sketch(df, (settings.partition_key, "chunk_id"), keys=keys)
    return rebalance(df, settings.partition_key)


def layout_keys(chunks: DataFrame, settings: JobSettings) -> DataFrame:
    """What a range layout orders by, from rows of the chunk stage."""
    return chunks.select(shard_id(F.col("chunk_id"), settings.shards).alias(settings.partition_key), "chunk_id")

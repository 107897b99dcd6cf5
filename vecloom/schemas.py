"""Fixed input and output schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = T.MapType(T.StringType(), T.StringType())

RAW = T.StructType(
    [
        T.StructField("document_id", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

VECTOR = T.StructType(
    [
        T.StructField("chunk_id", T.StringType(), False),
        T.StructField("document_id", T.StringType(), False),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("total_chunks", T.IntegerType(), False),
        T.StructField("chunk_content", T.StringType(), False),
        T.StructField("token_count", T.IntegerType(), False),
        T.StructField("start_char", T.IntegerType(), False),
        T.StructField("end_char", T.IntegerType(), False),
        T.StructField("vector_fp32", T.ArrayType(T.FloatType())),
        T.StructField("vector_int8", T.BinaryType()),
        T.StructField("scale_factor", T.FloatType(), False),
        T.StructField("zero_point", T.IntegerType(), False),
        T.StructField("l2_norm", T.FloatType(), False),
        T.StructField("partition_id", T.IntegerType(), False),
        T.StructField("metadata", METADATA),
    ]
)


def empty_metadata() -> Column:
    return F.from_json(F.lit("{}"), METADATA)


def raw_defaults(df: DataFrame, ingested_at: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to RAW and fill the optional columns, whether absent or null; ``keep`` columns stay beside them."""
    now = F.lit(ingested_at) if ingested_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    fallback = {
        "source": F.lit("unknown"),
        "category": F.lit("general"),
        "timestamp": now,
        "metadata": empty_metadata(),
    }
    present = set(df.columns)
    columns = []
    for field in RAW:
        value = F.col(field.name).cast(field.dataType) if field.name in present else F.lit(None).cast(field.dataType)
        default = fallback.get(field.name)
        columns.append((value if default is None else F.coalesce(value, default)).alias(field.name))
    return df.select(*columns, *keep)


def vector_payload(df: DataFrame) -> DataFrame:
    """Select and cast to VECTOR, the declared output columns."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VECTOR])

"""Corpus readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.operators.partitioning import key_sketch, place_among
from vecloom.schemas import RAW, raw_defaults

CORRUPT = "_corrupt_record"
SPREAD_BYTES = 256 << 20
ACCEPTED = "accepted"
CAP_AT_ONCE = 1 << 17


def _json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines under the RAW schema; a malformed line becomes nulls plus its raw text."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in RAW], T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def cap_records(df: DataFrame, max_records: int, id_column: str = "document_id", at_once: int = CAP_AT_ONCE) -> DataFrame:
    """The first ``max_records`` rows by id.

    Up to ``at_once`` rows are taken in one pass. A larger cap is found by ranges: ids are counted
    between the bounds of a sketch, ranges below the cap are whole, and only the one range that
    the cap cuts is sorted, so no task sees more than about ``at_once`` rows in order.
    """
    if max_records <= at_once:
        return df.orderBy(id_column).limit(max_records)
    sketch = key_sketch(df, (id_column,))
    if sketch.n <= max_records:
        return df
    place = place_among(df, (id_column,), sketch.bounds(-(-sketch.n // at_once)))
    counts = sorted(df.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect())
    below = 0
    for last, n in counts:
        if below + n >= max_records:
            break
        below += n
    return df.filter(place < last).unionByName(df.filter(place == last).orderBy(id_column).limit(max_records - below))


def spread(df: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Give every core work when a small input arrives in fewer splits than there are cores.

    Moves at most ``max_bytes``, by the plan's own estimate; anything larger stays as it is read.
    Rows are dealt round robin, so no key matters.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > max_bytes or df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores)


def judged_corpus(spark: SparkSession, path: str, columns: dict[str, str] | None = None, ingested_at: str | None = None, with_file: bool = False) -> DataFrame:
    """Every stored row in the RAW columns, and a malformed JSON line's text; ``accepted`` tells which rows count.

    Parquet and JSON are judged alike. ``with_file`` adds the file that a row comes from.
    """
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))
    else:
        df = _json(spark, path)
    for name, stored in (columns or {}).items():
        df = df.withColumn(name, F.col(stored))
    if with_file:
        return raw_defaults(df.select("*", F.col("_metadata.file_path").alias("file")), ingested_at, keep=(CORRUPT, "file"))
    return raw_defaults(df, ingested_at, keep=(CORRUPT,))


def accepted(judged: DataFrame) -> DataFrame:
    """Rows that can be read and have an id and content; plain null tests, which reach the scan."""
    whole = F.col(CORRUPT).isNull() & F.col("document_id").isNotNull() & F.col("content").isNotNull()
    return judged.filter(whole).drop(CORRUPT)


def read_corpus(
    spark: SparkSession,
    path: str,
    max_records: int | None = None,
    columns: dict[str, str] | None = None,
    ingested_at: str | None = None,
) -> DataFrame:
    """Read ``*.parquet`` as Parquet and anything else as JSON lines, into the RAW columns.

    ``columns`` renames stored columns to RAW names ({"document_id": "doc_id", ...}). Rows
    without an id or content and malformed lines are returned by ``rejected_records``: the
    two together are every row of the input.
    """
    df = accepted(judged_corpus(spark, path, columns, ingested_at))
    return cap_records(df, max_records) if max_records else df


def _verdict() -> Column:
    return (
        F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("document_id").isNull(), "no id").when(F.col("content").isNull(), "no content")
    )


def _line() -> Column:
    """A malformed line as it stands, else the row's RAW columns as JSON."""
    return F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[f.name for f in RAW if f.name != "timestamp"])))


def store_judged(spark: SparkSession, path: str, target: str, columns: dict[str, str] | None = None, ingested_at: str | None = None) -> None:
    """Every row of the input in one scan, below ``target`` by verdict; the two readers that follow open their own part only.

    ``verdict=accepted`` has the corpus, the others the rejected rows with their reason.
    """
    judged = judged_corpus(spark, path, columns, ingested_at, with_file=True)
    line = F.when(_verdict().isNotNull(), _line()).alias("line")
    rows = judged.select(*[f.name for f in RAW], "file", line, F.coalesce(_verdict(), F.lit(ACCEPTED)).alias("verdict"))
    rows.write.partitionBy("verdict").parquet(target)


def stored_corpus(spark: SparkSession, target: str) -> DataFrame:
    """The accepted rows of ``store_judged``."""
    return spark.read.parquet(target).filter(F.col("verdict") == ACCEPTED).select(*[f.name for f in RAW])


def stored_rejects(spark: SparkSession, target: str) -> DataFrame:
    """The rejected rows of ``store_judged``, as ``rejected_records`` lists them."""
    rows = spark.read.parquet(target).filter(F.col("verdict") != ACCEPTED)
    return rows.select("file", F.col("verdict").alias("reason"), "document_id", "line")


def rejected_records(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """(file, reason, document_id, line) of the rows that ``read_corpus`` leaves out.

    Reasons: ``malformed`` (a JSON line that cannot be read), ``no id``, ``no content``. ``line``
    is a malformed line as it stands, else the row's RAW columns as JSON.
    """
    judged = judged_corpus(spark, path, columns, "", with_file=True).withColumn("reason", _verdict())
    return judged.filter(F.col("reason").isNotNull()).select("file", "reason", "document_id", _line().alias("line"))


def corrupt_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, document_id, line) of malformed JSON lines; the id is null unless it could be read."""
    return rejected_records(spark, path).filter(F.col("reason") == "malformed").drop("reason")

"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest. A batch of new rows is reduced to
one row per digest, rows already indexed are found by a sort-merge anti-join that does not
shuffle the index, and the digests that are new are appended. Texts never enter a shuffle to
be compared, only digests do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.groups import attach
from vecloom.session import cut_lineage, scratch_path

BUCKETS = 64


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """The index at ``path``: ``digest`` binary and ``keep_id``, the id of the row that was kept.

    Opening a path that holds an index continues it. The bucket count is fixed when the index
    is made; choose it so that a bucket of the final index suits one task.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, id_type: str = "bigint"):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def new_groups(self, groups: DataFrame) -> DataFrame:
        """Groups whose digest is not indexed yet."""
        return groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Adds digests that are not in the index; one task writes one bucket."""
        new = self.new_groups(groups).select("digest", "keep_id")
        new.repartition(self.buckets, "digest").write.insertInto(self.table)

    def add(self, rows: DataFrame) -> DataFrame:
        """Deduplicates a batch (``doc_id``, ``digest``) and indexes it.

        Returns one row per input row: doc_id, digest, keep_id, group_size, kept, copies. In a
        group that the index has, no row is kept and ``keep_id`` is the indexed id; else the
        smallest ``doc_id`` is, a null only if there is no other. ``group_size`` counts rows
        of the batch. Of rows that repeat both id and text one is kept; ``copies`` counts them.
        """
        counted = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
        pairs = cut_lineage(counted)
        groups = cut_lineage(
            pairs.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("n_ids"))
        )
        new = cut_lineage(self.new_groups(groups))
        known = groups.drop("keep_id").join(self.rows().hint("merge"), "digest")
        found = new.withColumn("is_new", F.lit(True)).unionByName(known.withColumn("is_new", F.lit(False)))
        found = cut_lineage(found.select("digest", "keep_id", "group_size", "n_ids", "is_new"))
        self.append(new)
        joined = attach(pairs, found, "digest", pairs.count(), size="n_ids")
        first = F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))
        return joined.select("doc_id", "digest", "keep_id", "group_size", "copies", first.alias("first"), copy.alias("copy")).select(
            "doc_id", "digest", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "copies"
        )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row, written once: all that follows reads this small table."""
    return cut_lineage(docs.select("doc_id", text_digest(F.col("text")).alias("digest")))


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document, dropped ones too; see ``DigestIndex.add``. Without an index, a new one."""
    spark = docs.sparkSession
    rows = digests(docs)
    index = index or DigestIndex(spark, scratch_path(spark, "digests"), id_type=dict(rows.dtypes)["doc_id"])
    return index.add(rows)


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns, extra ones too.

    Rows leave by an anti-join with the ids and digests that were not kept, which names no
    document twice. Only rows that repeat a kept id and text are compared as rows.
    """
    decisions = cut_lineage(decide(docs, index))
    kept = decisions.filter("kept")
    gone = decisions.filter("not kept and not (copies > 1 and doc_id <=> keep_id)").select("doc_id", "digest").distinct()
    repeated = kept.filter("copies > 1").select("doc_id", "digest")
    some_repeat = not repeated.isEmpty()
    out = gone.unionByName(repeated) if some_repeat else gone
    names = docs.columns
    rows = docs.alias("d").withColumn("_digest", text_digest(F.col("text")))

    def same(other: DataFrame) -> Column:
        return (F.col("d.doc_id").eqNullSafe(other["_id"])) & (F.col("_digest") == other["_of"])

    def named(other: DataFrame) -> DataFrame:
        return other.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_of"))

    stay = rows.join(out := named(out), same(out), "left_anti")
    if some_repeat:
        again = rows.join(more := named(repeated), same(more), "left_semi")
        stay = stay.unionByName(again.dropDuplicates(["doc_id", "_digest"]))
    return stay.select(*names)

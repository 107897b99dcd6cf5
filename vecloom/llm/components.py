"""Connected components of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.session import cut_lineage


ROWS_PER_TASK = 200_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` small rows, dealt to as many tasks as they need: a small table is not written as many files.

    What makes the rows keeps its own width; only rows that are ready are dealt anew.
    """
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b), a written table; label is the smallest node it reaches.

    Each round a node takes the smallest label among its neighbours, then the label of its
    label, so the distance covered grows with every round. A node with many neighbours is
    combined on the map side.
    """
    rows = links.count()
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut_lineage(sized(both, 2 * rows))
    labels = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
    labels = cut_lineage(sized(labels, 2 * rows))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        nearer = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("by"))
        parent = labels.select(F.col("node").alias("by"), F.col("label").alias("of"))
        after = nearer.join(parent, "by", "left").select("node", "was", F.least("by", F.coalesce("of", "by")).alias("label"))
        after = cut_lineage(sized(after, 2 * rows))
        labels = after.drop("was")
        if after.filter("was <> label").isEmpty():
            return labels

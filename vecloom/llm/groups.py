"""Joins and ranks that stay even when one key holds a third of all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, total: int, size: str = "group_size") -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row per ``key`` and its row count in ``size``.

    A group with more than 1/HOT_SHARE of the ``total`` rows is hot. There are fewer than
    HOT_SHARE of them whatever the input, so they are broadcast and their rows do not move;
    all other rows meet their group by a shuffle in which no key is large.
    ``rows`` is read twice and should be a written table.
    """
    hot = groups.filter(F.col(size) * HOT_SHARE > total)
    cold = groups.filter(F.col(size) * HOT_SHARE <= total)
    found = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return found.unionByName(rest)


def rank_within(rows: DataFrame, key: str, order: list[Column], total: int, name: str = "rank") -> DataFrame:
    """Adds a rank from 0 among the rows of equal ``key``, without bringing a key together.

    Rows of a key are dealt over about sqrt(total) salts by the hash of ``order``; ranks are
    counted within a salt and shifted by the sizes of the salts before it. Which row gets
    which rank is fixed by ``order``. ``rows`` is read twice and should be a written table.
    """
    salts = max(1, math.isqrt(total))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    bases = bases.select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))
    ranked = salted.withColumn("_within", within).join(bases, [key, "_salt"])
    return ranked.withColumn(name, F.col("_base") + F.col("_within") - 1).drop("_salt", "_within", "_base")

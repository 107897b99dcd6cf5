"""Evaluate a column once and use it several times inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound to a lambda variable.

    Catalyst inlines columns into lambda bodies, where they would run once per
    array element; a bound variable runs once per row.
    """
    return F.transform(F.array(value), body)[0]


def once(df, **columns: Column):
    """Add columns behind a one-row generator.

    Filters and expressions on them stay above the generator, so an expensive column runs
    in one place instead of being copied into each of its uses.
    """
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.explode(F.array(fields)).alias("_once")).select(
        *[c for c in df.columns if c not in columns], *[F.col(f"_once.{name}").alias(name) for name in columns]
    )

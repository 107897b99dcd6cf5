"""Chunk explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.binding import once
from vecloom.functions.chunks import word_windows


def chunk(
    df: DataFrame,
    text: Column,
    size: int = 256,
    overlap: int = 32,
    id_column: str = "document_id",
    keep: tuple[str, ...] = ("source", "category"),
) -> DataFrame:
    """One row per word window of ``text``; a text without words gives none.

    Only the id and the ``keep`` columns travel with the chunks, not the text.
    """
    # bound first: Spark does not take a function to Python whose argument holds a lambda
    bound = once(df.select(id_column, *keep, text.alias("_given")), _text=F.col("_given")).drop("_given")
    exploded = bound.select(id_column, *keep, F.inline(word_windows(F.col("_text"), size, overlap)))
    return exploded.select(
        "*",
        F.concat(F.col(id_column), F.lit("_chk_"), F.col("chunk_index")).alias("chunk_id"),
        (F.col("start_char") + F.length("chunk_content")).alias("end_char"),
    )

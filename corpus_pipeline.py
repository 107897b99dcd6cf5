"""A corpus cleaned and packed in stages; each calls one operator and takes what the one before it kept.

Rows with null ids or texts, repeated rows, texts of any length and an empty table go through
every stage: each states below what becomes of them. All but the last return the columns they
got, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vecloom.llm import decontamination, digest_index, ngram_join, packing, toxicity
from vecloom.llm.queries import table
from vecloom.session import cut_lineage


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts have the score of a text without words; repeated rows are scored alike; an empty table stays empty, and without labels nothing is rejected that scores below the threshold."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the one with the smallest doc_id, null ids last. A null text counts as empty, and one of these stays too; of rows that repeat id and text one stays."""
    return digest_index.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id. Texts without words, null ones too, are in no group and stay."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Texts and items without words hold none; with an empty benchmark all stay."""
    return decontamination.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents left, with their places in sequences. A null or empty text is its end id alone; repeated rows are packed each; no documents give no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxic documents", toxic_documents),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("benchmark leaks", benchmark_leaks),
    ("packed sequences", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the packing plan and the near-copy groups have no SQL statement; tests compare them with brute force.
ORACLE_SQL = None

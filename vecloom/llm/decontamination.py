"""Benchmark decontamination: windows of benchmark words found in training documents.

Benchmark items become a set of hashed word windows that is broadcast in blocks of a fixed
size. A document's words are scanned once per block: each position's window is hashed and
looked up in the same code-generated stage that made it, so nothing is shuffled but the
hits. A hit counts only if the words themselves are equal.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.session import cut_lineage

WINDOW = 10
#: Windows in one broadcast block: with ten words each, some tens of MB.
BLOCK_WINDOWS = 200_000
# What separates words, in a text whose letters A-Z are lower case.
SEPARATORS = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"


def lowered(text: Column) -> Column:
    """Letters A-Z in lower case, all others as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """Words of a whole text; null has none."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), f"[{SEPARATORS}]+"), "")


def window_hash(words: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from position ``at``; null where fewer are left."""
    parts = [F.get(words, at + i) for i in range(length)]
    return F.when(at + length <= F.size(words), F.xxhash64(*parts))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows (key, gram, length) with the ids of their items.

    Window count follows the benchmark's words; the table is written, and its size is
    what the choice of blocks looks at. An item without words has no window.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    grams = items.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, F.lit(window)))).alias("gram"))
    keys = [F.when(F.size("gram") == n, window_hash(F.col("gram"), F.lit(0), n)) for n in range(1, window + 1)]
    found = grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
    return cut_lineage(found.select(F.coalesce(*keys).alias("key"), "gram", F.size("gram").alias("length"), "items"))


def scan(docs: DataFrame, windows: DataFrame, lengths: list[int], block: Column, first: bool) -> DataFrame:
    """Marks and hits of one block of windows: per document, its rows for hits and, from the first block, one more."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    places = words.select("doc_id", "text_hash", "w", F.posexplode_outer("w").alias("at", "word")).drop("word")
    if lengths == [lengths[0]]:
        keyed = places.withColumn("key", window_hash(F.col("w"), F.col("at"), lengths[0])).withColumn("n", F.lit(lengths[0]))
    else:
        options = F.array(*[F.struct(F.lit(n).alias("n"), window_hash(F.col("w"), F.col("at"), n).alias("key")) for n in lengths])
        keyed = places.select("doc_id", "text_hash", "w", "at", F.explode(options).alias("o")).select("doc_id", "text_hash", "w", "at", "o.key", "o.n")
    grams = windows.filter(block).select(F.col("key").alias("gram_key"), "gram", F.col("length").alias("gram_length"), "items")
    equal = (F.col("key") == F.col("gram_key")) & (F.slice(F.col("w"), F.col("at") + 1, F.col("n")) == F.col("gram"))
    found = keyed.join(F.broadcast(grams), equal, "left")
    mark = (F.coalesce(F.col("at"), F.lit(0)) == 0) & (F.col("n") == lengths[0]) if first else F.lit(False)
    return found.filter(F.col("gram").isNotNull() | mark).select(
        "doc_id",
        "text_hash",
        F.when(mark, F.size("w")).alias("n_words"),
        F.when(F.col("gram").isNotNull(), F.struct("at", F.col("gram_length").alias("n"))).alias("hit"),
        "items",
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, spans (start and length of every hit window), items, rows.

    Rows that repeat both id and text are one row here, and ``rows`` counts them. Null ids are
    kept. A null or empty text has no words and no hits; an empty benchmark hits nothing.
    """
    windows = benchmark_windows(benchmark, window)
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect()) or [window]
    blocks = -(-windows.count() // block_windows) or 1
    scans = [scan(docs, windows, lengths, F.pmod("key", F.lit(blocks)) == b, b == 0) for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, scans).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("hit").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count("n_words").alias("rows"),
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, and the hit places."""
    found = hits(docs, benchmark, window, block_windows)
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))
    found = found.select("doc_id", "text_hash", "n_words", "items", F.array_sort(covered).alias("places"), F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")).alias("_row"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.size("places").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"),
        "text_hash",
        "places",
    )


def _with_hits(docs: DataFrame, benchmark: DataFrame, how: str, **settings: int) -> DataFrame:
    found = cut_lineage(report(docs, benchmark, **settings).filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("places").alias("_places")).dropDuplicates(["_id", "_hash"]))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_hash"]), how)


def drop_documents(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """The documents without any hit, all columns as they were."""
    return _with_hits(docs, benchmark, "left_anti", **settings).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """All documents, hit words taken out together with the separators before them; clean texts unchanged."""
    joined = _with_hits(docs, benchmark, "left", **settings)
    kind = SEPARATORS.replace("\\x3A-\\x60", "\\x3A-\\x40\\x5B-\\x60")
    pieces = F.regexp_extract_all("text", F.lit(f"[{kind}]*[^{kind}]+"), 0)
    tail = F.regexp_extract("text", f"[{kind}]*$", 0)
    def between(k: Column) -> Column:
        start = F.when(k > 0, F.get("_places", k - 1) + 1).otherwise(0)
        end = F.when(k < F.size("_places"), F.get("_places", k)).otherwise(F.size("_pieces"))
        return F.slice("_pieces", start + 1, end - start)

    runs = F.transform(F.sequence(F.lit(0), F.size("_places")), between)
    left = F.array_join(F.flatten(runs), "")
    cleaned = F.when(F.col("_places").isNull(), F.col("text")).otherwise(F.concat(left, tail))
    return joined.withColumn("_pieces", pieces).select(*[cleaned.alias("text") if c == "text" else docs[c] for c in docs.columns])

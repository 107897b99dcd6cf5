"""Best-fit packing of documents into sequences of a fixed length.

The plan is made for counts of lengths, not for documents: a histogram of at most ``capacity``
numbers reaches the driver, best fit runs over it, and the plan is a short list of slot runs.
Each piece then takes the slot that has its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded
from vecloom.llm.encoding import SLICE_BYTES, encoder, with_end
from vecloom.llm.groups import rank_within
from vecloom.session import cut_lineage

CAPACITY = 4096
END_ID = 1
RUN_SCHEMA = "length bigint, rank_start bigint, rank_end bigint, first_sequence bigint, per_sequence bigint, first_offset bigint"


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slot runs for ``histogram`` (length to count), in the columns of RUN_SCHEMA.

    Lengths are taken from the longest; an item goes where it leaves the least space, and to
    a new sequence only if it fits nowhere. Sequences of equal space are one entry, so the
    work follows the number of distinct lengths. Ranks of a length fill its runs in turn,
    ``per_sequence`` of them in each sequence.
    """
    spaces: list[int] = []
    ranges: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in ranges:
                bisect.insort(spaces, space)
                ranges[space] = []
            ranges[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = ranges[space].pop()
                if not ranges[space]:
                    del ranges[space]
                    spaces.pop(at)
            else:
                space, first, count = capacity, sequences, -(-left // (capacity // length))
                sequences += count
            each = min(space // length, left)
            used = min(count, left // each)
            runs.append((length, rank, rank + used * each, first, each, capacity - space))
            put(space - each * length, first, used)
            put(space, first + used, count - used)
            rank, left = rank + used * each, left - used * each
    return runs


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, special_as_text: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (binary, unsigned 32-bit little-endian)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path, special_as_text)
        for batch in bounded(batches, "text", SLICE_BYTES):
            ids, bounds = with_end(*coder.encode(batch.column("text")), end_id)
            size = np.diff(bounds)
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            parts = [ids[a : a + k].astype("<u4", copy=False).tobytes() for a, k in zip((bounds[row] + start).tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces; ``cut`` must be a written table, as it is read four times.

    Pieces of equal length are interchangeable: ranks go by doc_id, piece and checksum.
    """
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = cut.sparkSession.createDataFrame(best_fit(histogram, capacity), RUN_SCHEMA)
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = rank_within(cut, "length", order, sum(histogram.values()))
    in_run = (F.col("rank") >= F.col("rank_start")) & (F.col("rank") < F.col("rank_end"))
    slots = ranked.join(F.broadcast(runs.withColumnRenamed("length", "run_length")), (F.col("length") == F.col("run_length")) & in_run)
    nth = F.col("rank") - F.col("rank_start")
    sequence = F.col("first_sequence") + F.floor(nth / F.col("per_sequence")).cast("bigint")
    offset = F.col("first_offset") + nth % F.col("per_sequence") * F.col("length")
    return slots.select(*cut.columns, sequence.alias("sequence_id"), offset.alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    A null or empty text is its end id alone. Rows that repeat a doc_id are packed each. An
    empty table gives no rows. ``with_ids`` keeps the ids of each piece. Other columns of
    ``docs`` are not read.
    """
    cut = pieces(docs, tokenizer_path, capacity, end_id, special_as_text)
    return place(cut_lineage(cut if with_ids else cut.drop("ids")), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, its ids in order and where its pieces begin, from ``pack(..., with_ids=True)``.

    A group is one sequence, so it is bounded by the capacity.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    found = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return found.select("sequence_id", F.col("parts.offset").alias("offsets"), F.col("parts.doc_id").alias("doc_ids"), joined.alias("ids"))

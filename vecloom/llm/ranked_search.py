"""Ranked lexical search over posting lists with range-maximum tables.

The index is made of shards, each the documents of a few megabytes of text in order of id,
with one posting list per term. A shard answers a query best-first: an interval of documents
is bounded by the sum, over the query's terms, of the largest impact in the interval, which a
sparse table per posting list answers in two look-ups. The interval of the largest bound is
split at the document of its largest impact, which is scored in full; what is left of it and
right of it are new intervals. Intervals below the k-th score are never opened. Short ones are
scored as a whole.

Shards are files of the shared folder, named by a manifest. Counts over all documents come
from the manifest and the shards' dictionaries before any score is taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded, spans
from vecloom.llm.shared_files import new_file, open_stream
from vecloom.llm.shingles import word_digests
from vecloom.session import cut_lineage, scratch_path

#: Text of one shard, and its documents at most.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
#: Intervals opened in one step; postings of an interval that is scored as a whole.
AT_ONCE, LEAF = 32, 1024
#: Terms of the queries that are asked together.
BLOCK_TERMS = 1 << 18
#: One in so many shards is searched first; the k-th score found there is a floor for all others.
FIRST_SHARE = 16
TOP = 50
_bytes = np.arange(256)
_SEPARATOR = ~(((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes > 127))


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all terms in order, and where each row's begin and the last one's end."""
    return word_digests(column, _SEPARATOR)


@dataclass
class Shard:
    """Posting lists of some documents: list t is ``start[t]`` to ``start[t + 1]`` of ``docs`` and ``tf``."""

    terms: np.ndarray
    start: np.ndarray
    docs: np.ndarray
    tf: np.ndarray
    lengths: np.ndarray
    ids: pa.Array

    @classmethod
    def of(cls, ids: pa.Array, texts: pa.Array) -> Shard:
        order = pc.sort_indices(ids, null_placement="at_end")
        ids, texts = ids.take(order), texts.take(order)
        digests, bounds = text_terms(texts)
        lengths = np.diff(bounds)
        row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        order = np.argsort(digests, kind="stable")
        digests, row = digests[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (digests[1:] != digests[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(row))).astype(np.int32)
        digests, docs = digests[at], row[at]
        first = np.flatnonzero(np.concatenate(([True], digests[1:] != digests[:-1]))) if len(at) else at
        return cls(digests[first], np.append(first, len(at)).astype(np.int64), docs, tf, lengths.astype(np.int64), ids)

    def write(self, folder: str) -> str:
        uri, stream = new_file(folder, ".postings")
        ids = pa.RecordBatch.from_arrays([self.ids], names=["id"])
        with pa.BufferOutputStream() as sink:
            with pa.ipc.new_stream(sink, ids.schema) as writer:
                writer.write_batch(ids)
            held = sink.getvalue().to_pybytes()
        with stream:
            for part in (self.terms, self.start, self.docs, self.tf, self.lengths, np.frombuffer(held, np.uint8)):
                packed = zstandard.compress(np.ascontiguousarray(part).tobytes(), 1)
                stream.write(np.array([len(packed)], np.int64).tobytes() + packed)
        return uri

    @staticmethod
    def sections(uri: str) -> Iterator[bytes]:
        with open_stream(uri) as stream:
            while size := stream.read(8):
                yield zstandard.decompress(stream.read(int(np.frombuffer(size, np.int64)[0])))

    @classmethod
    def read(cls, uri: str) -> Shard:
        kinds = (np.uint64, np.int64, np.int32, np.int32, np.int64)
        *parts, held = cls.sections(uri)
        with pa.ipc.open_stream(held) as reader:
            ids = reader.read_next_batch().column(0)
        return cls(*(np.frombuffer(p, kind) for p, kind in zip(parts, kinds, strict=True)), ids)

    @classmethod
    def dictionary(cls, uri: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms and the numbers of documents that hold them."""
        parts = cls.sections(uri)
        terms, start = np.frombuffer(next(parts), np.uint64), np.frombuffer(next(parts), np.int64)
        return terms, np.diff(start)


def found_in(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted ``terms``, and their places there."""
    place = np.searchsorted(terms, wanted)
    held = np.flatnonzero(place < len(terms))
    held = held[terms[place[held]] == wanted[held]]
    return held, place[held]


def impacts(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a posting adds to a score for each unit of its term's weight."""
    m = 50 + 50 * lengths * n_docs // n_terms
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Lists:
    """The posting lists of some terms of a shard, ready for range-maximum search."""

    def __init__(self, shard: Shard, places: np.ndarray, n_docs: int, n_terms: int):
        sizes = shard.start[places + 1] - shard.start[places]
        at = spans(sizes, shard.start[places])
        self.docs, self.width = shard.docs[at], max(1, len(shard.lengths))
        self.impact = impacts(shard.tf[at], shard.lengths[self.docs], n_docs, n_terms)
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.key = np.repeat(np.arange(len(sizes)), sizes) * self.width + self.docs
        # Row j: where the largest of 2**j impacts from each place on stands. No answer crosses a list's end.
        levels = [np.arange(len(at), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= (int(sizes.max()) if len(sizes) else 0):
            half, last = 1 << (len(levels) - 1), levels[-1]
            ahead = np.concatenate((last[half:], last[len(last) - half :]))
            levels.append(np.where(self.impact[last] >= self.impact[ahead], last, ahead))
        self.table = np.stack(levels)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the largest impact from ``low`` to ``high``; the value of an empty range is 0."""
        size = high - low
        some = size > 0
        j = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        last = self.table.shape[1] - 1
        a = self.table[j, np.minimum(low, last)]
        b = self.table[j, np.clip(high - (1 << j.astype(np.int64)), 0, last)]
        place = np.where(self.impact[a] >= self.impact[b], a, b)
        return place, self.impact[place] * some

    def best(self, lists: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best with a score of ``floor`` or more, ties by document."""
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        low, high = self.begin[lists][None], self.end[lists][None]
        bound = (self.largest(low, high)[1] * weights).sum(axis=1)
        self.opened = 0
        while len(bound):
            least, last = (scores[-1], docs[-1]) if len(docs) == k else (floor, self.width)
            first = np.where(low < high, self.docs[np.minimum(low, len(self.docs) - 1)], self.width).min(axis=1)
            alive = np.flatnonzero((bound >= floor) & ((bound > least) | ((bound == least) & (first < last))))
            low, high, bound = low[alive], high[alive], bound[alive]
            if not len(bound):
                break
            order = np.argsort(-bound, kind="stable")
            now, rest = order[:AT_ONCE], order[AT_ONCE:]
            self.opened += len(now)
            some_low, some_high = low[now], high[now]
            short = (some_high - some_low).sum(axis=1) <= LEAF
            got = [(docs, scores), self.whole(some_low[short], some_high[short], weights)]
            some_low, some_high = some_low[~short], some_high[~short]
            place, value = self.largest(some_low, some_high)
            split = self.docs[np.take_along_axis(place, np.argmax(value * weights, axis=1)[:, None], axis=1)[:, 0]]
            at = np.searchsorted(self.key, lists[None] * self.width + split[:, None])
            hit = (at < some_high) & (self.docs[np.minimum(at, len(self.docs) - 1)] == split[:, None])
            got.append((split.astype(np.int64), (self.impact[np.minimum(at, len(self.docs) - 1)] * hit * weights).sum(axis=1)))
            new_low, new_high = np.concatenate((some_low, at + hit)), np.concatenate((at, some_high))
            held = (new_low < new_high).any(axis=1)
            new_low, new_high = new_low[held], new_high[held]
            low, high = np.concatenate((low[rest], new_low)), np.concatenate((high[rest], new_high))
            bound = np.concatenate((bound[rest], (self.largest(new_low, new_high)[1] * weights).sum(axis=1)))
            docs, scores = (np.concatenate(x) for x in zip(*got, strict=True))
            good = scores >= floor
            docs, scores = docs[good], scores[good]
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
        return docs, scores

    def whole(self, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents of disjoint intervals with their scores."""
        sizes = (high - low).ravel()
        at = spans(sizes, low.ravel())
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        order = np.argsort(self.docs[at], kind="stable")
        docs = self.docs[at][order]
        value = (self.impact[at] * np.repeat(np.tile(weights, len(low)), sizes))[order]
        first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        return docs[first].astype(np.int64), np.add.reduceat(value, first)


def build(docs: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the index of all documents, whole texts, and returns its manifest: uri, n_docs (with a term), n_terms.

    A task writes its documents in shards of up to ``shard_bytes`` of text; nothing is
    shuffled. Null and empty texts are rows without terms. Repeated rows are documents of
    their own. ``docs`` may have any other columns.
    """
    folder = folder or scratch_path(docs.sparkSession, "postings")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = rows = 0

        def flushed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            shard = Shard.of(table.column("doc_id").combine_chunks(), table.column("text").combine_chunks())
            numbers = [[int((shard.lengths > 0).sum())], [int(shard.lengths.sum())]]
            return pa.RecordBatch.from_arrays([pa.array([shard.write(folder)]), *(pa.array(n, pa.int64()) for n in numbers)], names=["uri", "n_docs", "n_terms"])

        for batch in bounded(batches, "text", shard_bytes // 4):
            more = batch.column("text").nbytes
            if held and (size + more > shard_bytes or rows + batch.num_rows > SHARD_DOCS):
                yield flushed()
                held, size, rows = [], 0, 0
            held.append(batch)
            size, rows = size + more, rows + batch.num_rows
        if held:
            yield flushed()

    return cut_lineage(docs.select("doc_id", "text").mapInArrow(write, "uri string, n_docs bigint, n_terms bigint"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item; rows of equal id, null too, are one item."""
    kind = queries.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", SHARD_BYTES):
            digests, bounds = text_terms(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(digests.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], names=["item_id", "terms"])

    rows = queries.select("item_id", "text").mapInArrow(split, f"item_id {kind}, terms array<bigint>")
    return rows.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))


@dataclass
class Block:
    """Queries that are asked together: item i has ``term[bounds[i]]`` to ``term[bounds[i + 1]]``, places in ``terms``."""

    items: pa.Array
    bounds: np.ndarray
    term: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    floors: np.ndarray


def search_shard(block: Block, uri: str, n_docs: int, n_terms: int, k: int) -> pa.RecordBatch:
    shard = Shard.read(uri)
    held, places = found_in(shard.terms, block.terms)
    lists = Lists(shard, places, n_docs, n_terms)
    slot = np.full(len(block.terms), -1)
    slot[held] = np.arange(len(held))
    items, docs, scores = [], [], []
    for i in range(len(block.items)):
        term = block.term[block.bounds[i] : block.bounds[i + 1]]
        term = term[slot[term] >= 0]
        if len(term):
            some, score = lists.best(slot[term], block.weights[term], k, int(block.floors[i]))
            items.append(np.full(len(some), i))
            docs.append(some)
            scores.append(score)
    none = [np.empty(0, np.int64)]
    item, doc = np.concatenate(items or none), np.concatenate(docs or none)
    columns = [block.items.take(pa.array(item)), pa.array(item), shard.ids.take(pa.array(doc)), pa.array(np.concatenate(scores or none))]
    return pa.RecordBatch.from_arrays(columns, names=["item_id", "item", "doc_id", "score"])


def search(index: DataFrame, queries: DataFrame, ids: str = "bigint", k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score; only scores above 0, ties by doc_id, null last.

    ``index`` is a manifest of ``build``, ``ids`` the type of doc_id there. Items go out in
    blocks of about ``block_terms`` terms, which the executors hold one at a time; a block is
    a part of the stated queries, whatever the number of documents. Each block reads the
    dictionaries for its terms' counts, then one in FIRST_SHARE shards, then the others with
    the k-th score so far as each item's floor. A shard gives at most ``k`` rows an item.
    An item without terms has no rows. Null texts have no terms.
    """
    spark = index.sparkSession
    n_docs, n_terms, shards = index.agg(F.sum("n_docs"), F.sum("n_terms"), F.count(F.lit(1))).first()
    kind = queries.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, item bigint, doc_id {ids}, score bigint"
    asked = cut_lineage(query_terms(queries).filter(F.size("terms") > 0))
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms) if n_terms else 0
    found = []
    tasks = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism), shards // 16)
    dealt = index.select("uri").repartition(tasks, "uri")
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow().combine_chunks()
        lists = rows.column("terms").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int64()))
        every = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        terms, term = np.unique(every, return_inverse=True)
        block = Block(rows.column("item_id").combine_chunks(), lists.offsets.to_numpy().astype(np.int64), term, terms, np.empty(0), np.ones(rows.num_rows, np.int64))
        holding = document_counts(dealt, terms)
        block.weights = np.array([weight(d, n_docs) for d in holding.tolist()], np.int64)
        place = F.pmod(F.xxhash64("uri"), F.lit(FIRST_SHARE))
        first = cut_lineage(asked_of(dealt.filter(place == 0), block, n_docs, n_terms, k, schema))
        ranks = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        floors = first.withColumn("_rank", ranks).filter(F.col("_rank") == k).select("item", "score").toArrow()
        block.floors[floors.column("item").to_numpy()] = np.maximum(1, floors.column("score").to_numpy())
        found += [first, cut_lineage(asked_of(dealt.filter(place != 0), block, n_docs, n_terms, k, schema))]
    rows = spark.createDataFrame([], schema)
    for part in found:
        rows = rows.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def document_counts(shards: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How many documents hold each of the sorted ``terms``."""
    held = shards.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(held.value), np.int64)
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                known, df = Shard.dictionary(uri)
                some, place = found_in(known, held.value)
                total[some] += df[place]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    rows = shards.mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(terms), np.int64)
    out[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return out


def asked_of(shards: DataFrame, block: Block, n_docs: int, n_terms: int, k: int, schema: str) -> DataFrame:
    held = shards.sparkSession.sparkContext.broadcast(block)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                yield search_shard(held.value, uri, n_docs, n_terms, k)

    return shards.mapInArrow(answers, schema)


def rank(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """Index and search in one go."""
    return search(build(docs), queries, docs.schema["doc_id"].dataType.simpleString(), k)

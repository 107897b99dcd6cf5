"""Alignment of two tokenizers over a corpus.

Byte offsets where tokens of both end cut a text into groups; all pairs of an A and a B token
in one group are linked, and a pair counts the documents that hold it linked.

Most groups are one A token and the B token of the same bytes. For these an identity map from
A ids to B ids is made beforehand; their counts are a vector as long as the vocabulary. Only
other pairs are counted by a shuffle, after they are summed up in each task.

A text is cut at single spaces between two visible characters, where both tokenizers begin a
new token. Each distinct cut is tokenized and aligned once per process; a document puts
together what its cuts have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded, release_memory, spans, text_buffer
from vecloom.llm.encoding import Encoder, cuts
from vecloom.session import cut_lineage

SLICE_BYTES = 2 << 20
#: The memo of cuts is begun anew beyond so many cuts or so many bytes of what they have.
MEMO_CUTS, MEMO_BYTES = 200_000, 48 << 20
#: New cuts that are tokenized in one call.
CUTS_AT_ONCE = 20_000
#: Links of a group that are listed one by one; larger groups are counted by distinct ids.
LISTED = 4096
#: Distinct pairs held by a counting task; beyond them it hands on partial counts.
HELD_PAIRS = 1 << 20
#: Pairs with more than one in so many of all counts are hot: there are fewer than that.
HOT_SHARE = 1 << 16


def byte_level(tokens: list[str]) -> list[bytes]:
    """Bytes of byte-level tokens: printable Latin-1 characters stand for themselves, the other bytes for 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return [bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t in tokens]


class Aligner:
    """Aligns text columns; holds what the process has aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.encoder = Encoder(path_a, special_as_text=True)
        vocabulary = self.encoder.tokenizer.get_vocab()
        names = [""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            names[i] = token
        self.bytes_a = byte_level(names)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_b = self.pieces.get_piece_size()
        known = [self.pieces.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(known)]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # Pieces come after single bytes, so a piece of the same bytes is taken before a fallback byte.
        same = {t: i for i, t in enumerate(self.bytes_b) if not self.pieces.is_control(i) and not self.pieces.is_unknown(i)}
        self.same = np.array([same.get(t, -1) for t in self.bytes_a], np.int64)
        ids = [str(i).encode() for i in range(max(len(self.bytes_a), self.n_b))]
        self.shown = [i + mark for mark in (b",", b"|", b";") for i in ids]
        self.n_shown = len(ids)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[bytes] = []
        self.counts = np.empty((0, 4), np.int64)
        self.good = np.empty(0, bool)
        self.start, self.pairs, self.times = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.bytes = 0

    def ids_a(self, new: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all cuts, and where each cut's begin and the last one's end."""
        regular = self.encoder.regular(new)
        found = self.encoder.lists_by_bytes([new[i] for i in regular], [len(raw[i]) for i in regular], self.size_a)
        if found is None or len(regular) < len(new):
            rest = np.ones(len(new), bool)
            rest[regular if found is not None else []] = False
            others, bounds = self.encoder.encode(pa.array([c for c, r in zip(new, rest.tolist(), strict=True) if r], pa.large_string()))
            self.encoder.forget()
            release_memory()
            if found is None:
                return others, bounds
            ids, stops = found
            count, begin = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
            count[regular], count[rest] = np.diff(stops, prepend=0), np.diff(bounds)
            begin[regular], begin[rest] = stops - np.diff(stops, prepend=0), len(ids) + bounds[:-1]
            return np.concatenate((ids, others.astype(np.int64)))[spans(count, begin)], np.concatenate(([0], np.cumsum(count)))
        release_memory()
        return found[0], np.concatenate(([0], found[1]))

    def giving_back(self, lists: list[list[int]], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which cuts' B tokens give their bytes back, how many tokens those have (others none), and their ids."""
        n_b = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        total = np.concatenate(([0], np.cumsum(self.size_b[b])))
        same_sizes = np.diff(total[np.concatenate(([0], np.cumsum(n_b)))]) == np.fromiter(map(len, raw), np.int64, len(raw))
        # cuts of the right sizes that give all bytes back together do so each
        if same_sizes.all() and b"".join(map(self.bytes_b.__getitem__, chain.from_iterable(lists))) == b"".join(raw):
            return same_sizes, n_b, b
        good = np.array([b"".join(map(self.bytes_b.__getitem__, x)) == c for x, c in zip(lists, raw, strict=True)], bool)
        return good, n_b * good, b[np.repeat(good, n_b)]

    def learn(self, new: list[str]) -> None:
        """Tokenizes and aligns new cuts, each of which begins with a space."""
        raw = [c.encode() for c in new]
        ids_a, bound_a = self.ids_a(new, raw)
        lists = self.pieces.encode([c[1:] for c in new], num_threads=1)
        good, n_b, b = self.giving_back(lists, raw)
        n_a = np.diff(bound_a) * good
        a = ids_a[np.repeat(good, np.diff(bound_a))].astype(np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        cut_of = np.zeros(len(common), np.int64)
        cut_of[group_a] = np.repeat(np.arange(len(new)), n_a)
        links = in_a * in_b
        counts = np.stack([n_a, n_b, np.bincount(cut_of, minlength=len(new)), np.bincount(cut_of, links, minlength=len(new)).astype(np.int64)], axis=1)

        # Every link as its pair; of large groups each distinct pair with the number of its links, all in the order of cuts.
        begin_a, begin_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        listed = links <= LISTED
        each = np.where(listed[group_a], in_b[group_a], 0)
        pair = np.repeat(a, each) * self.n_b + b[spans(each, begin_b[group_a])]
        owner, times = np.repeat(cut_of[group_a], each), np.ones(len(pair), np.int64)
        for g in np.flatnonzero(~listed).tolist():
            some_a, times_a = np.unique(a[begin_a[g] : begin_a[g] + in_a[g]], return_counts=True)
            some_b, times_b = np.unique(b[begin_b[g] : begin_b[g] + in_b[g]], return_counts=True)
            more = (some_a[:, None] * self.n_b + some_b).ravel()
            pair, owner = np.concatenate((pair, more)), np.concatenate((owner, np.full(len(more), cut_of[g])))
            times = np.concatenate((times, (times_a[:, None] * times_b).ravel()))
        order = np.argsort(owner, kind="stable")
        pair, times = pair[order], times[order]
        stored = np.bincount(owner, minlength=len(new))

        # The groups as text, with the mark that follows each id.
        token, group = np.concatenate((a, b)), np.concatenate((group_a, group_b))
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        part = (2 * group + side)[order]
        last = np.append(part[1:] != part[:-1], True) if len(part) else np.empty(0, bool)
        code = token[order] + self.n_shown * np.where(last, 1 + side[order], 0)
        shown = [self.shown[i] for i in code.tolist()]
        stops = np.cumsum(n_a + n_b).tolist()
        self.text += [b"".join(shown[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=True)]
        first = len(self.place)
        self.place.update((c, first + i) for i, c in enumerate(new))
        self.counts, self.good = np.concatenate((self.counts, counts)), np.concatenate((self.good, good))
        self.start = np.concatenate((self.start, len(self.pairs) + np.cumsum(stored)))
        self.pairs, self.times = np.concatenate((self.pairs, pair)), np.concatenate((self.times, times))
        self.bytes += sum(map(len, new)) + 16 * len(pair) + sum(map(len, self.text[first:]))

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per row n_a, n_b, n_groups, n_links and the groups' digest; distinct (row, pair) in order, and how often each is linked."""
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        column = pc.binary_join_element_wise(space, column.fill_null("").cast(pa.large_string()), nothing)
        data, ends = text_buffer(column)
        starts = cuts(data, ends)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        if len(self.place) > MEMO_CUTS or self.bytes > MEMO_BYTES:
            self.forget()
        distinct = pieces.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.place]
        for k in range(0, len(new), CUTS_AT_ONCE):
            self.learn(new[k : k + CUTS_AT_ONCE])
        cut = np.array([self.place[c] for c in distinct], np.int64)[pieces.indices.to_numpy()]
        bounds = np.searchsorted(starts, ends)
        wrong = np.concatenate(([0], np.cumsum(~self.good[cut])))
        whole = (wrong[bounds[1:]] == wrong[bounds[:-1]]) & (np.diff(ends) > 1)
        keep = np.repeat(whole, np.diff(bounds))
        row = np.repeat(np.arange(len(whole)), np.diff(bounds))[keep]
        cut = cut[keep]
        counts = np.zeros((len(whole), 4), np.int64)
        for j in range(4):
            counts[:, j] = np.bincount(row, self.counts[cut, j], minlength=len(whole))
        digests, at = [], 0
        texts = [self.text[i] for i in cut.tolist()]
        for n in np.bincount(row, minlength=len(whole)).tolist():
            digests.append(hashlib.sha256(b"".join(texts[at : at + n])[:-1]).hexdigest() if n else "")
            at += n
        stored, every = np.diff(self.start)[cut], len(self.bytes_a) * self.n_b
        at = spans(stored, self.start[:-1][cut])
        key = np.repeat(row, stored) * every + self.pairs[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        times = np.add.reduceat(self.times[at][order], first) if len(key) else first
        return counts, digests, key[first] // every, key[first] % every, times


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def lists_of(row: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
    """``values``, which come in the order of ``row``, as one list per row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pa.array(values))


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's links: _row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times.

    ``pairs`` are the distinct linked pairs, A id times B's vocabulary plus B id, ``times`` how
    often each is linked. Texts that are null, empty, or whose tokens do not give the text
    back have none. Row-local; a written table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["_row", "doc_id", *_COUNTS, "groups_sha256", "pairs", "times"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        at = TaskContext.get().partitionId() << 40
        for batch in bounded(batches, "text", SLICE_BYTES):
            counts, digests, row, pair, times = both(batch.column("text"))
            rows = [pa.array(np.arange(at, at + len(counts))), batch.column("doc_id"), *(pa.array(counts[:, j]) for j in range(4)), pa.array(digests, pa.string())]
            at += len(counts)
            yield pa.RecordBatch.from_arrays([*rows, lists_of(row, len(counts), pair), lists_of(row, len(counts), times)], names=names)

    schema = f"_row bigint, doc_id {kind}, {', '.join(f'{c} bigint' for c in _COUNTS)}, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    return cut_lineage(docs.select("doc_id", "text").mapInArrow(aligned, schema))


def pair_counts(found: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, documents) of every linked pair; pairs of the identity map travel as one vector per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        regular = np.zeros(len(both.same), np.int64)
        held, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def rows(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "documents"])

        for batch in batches:
            pair = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            a = pair // both.n_b
            direct = both.same[a] == pair % both.n_b
            regular += np.bincount(a[direct], minlength=len(regular))
            more, n = np.unique(pair[~direct], return_counts=True)
            held, at = np.unique(np.concatenate((held, more)), return_inverse=True)
            times = np.bincount(at, np.concatenate((times, n)), minlength=len(held)).astype(np.int64)
            if len(held) > HELD_PAIRS:
                yield rows(held, times)
                held, times = held[:0], times[:0]
        yield rows(held, times)
        some = np.flatnonzero(regular)
        yield rows(some * both.n_b + both.same[some], regular[some])

    return cut_lineage(found.select("pairs").mapInArrow(count, "pair bigint, documents bigint").groupBy("pair").agg(F.sum("documents").alias("documents")))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` are the links whose pair's count is the highest of its A id, ties included;
    ``count_sum`` adds up the counts of all links. Null and empty texts, and texts whose
    tokens do not give them back, have zeros and an empty digest. Repeated rows and null ids
    are documents of their own; other columns do no harm; an empty table gives no rows.

    Counts of the identity map, each A id's highest count, and the hot pairs (over
    1/HOT_SHARE of all counts, so fewer than HOT_SHARE of them) go to the executors; what is
    left of a document meets its counts by pair, where no pair is hot any more.
    """
    found = links(docs, path_a, path_b)
    both = aligner(path_a, path_b)
    n_b, same = both.n_b, both.same
    counts = pair_counts(found, path_a, path_b)
    total = counts.agg(F.sum("documents")).first()[0] or 0
    best = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("documents").alias("most"))
    most = np.zeros(len(same), np.int64)
    rows = best.toArrow()
    most[rows.column("a").to_numpy()] = rows.column("most").to_numpy()
    some = np.flatnonzero(same >= 0)
    map_pairs = docs.sparkSession.createDataFrame(pa.table({"pair": some * n_b + same[some]}))
    direct = counts.join(F.broadcast(map_pairs), "pair", "left_semi").toArrow()
    hot = counts.filter(F.col("documents") * HOT_SHARE > total).toArrow()
    near = {k: np.concatenate([t.column(k).to_numpy() for t in (direct, hot)]) for k in ("pair", "documents")}
    near_pair, at = np.unique(near["pair"], return_index=True)
    known = docs.sparkSession.sparkContext.broadcast((near_pair, near["documents"][at], most))
    names = ["_row", "doc_id", *_COUNTS, "groups_sha256", "n_best", "count_sum", "pairs", "times"]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, documents, highest = known.value
        for batch in batches:
            n = batch.num_rows
            row = pc.list_parent_indices(batch.column("pairs")).to_numpy()
            pair = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            near = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)
            value = documents[place[near]]
            # Sums of integers as 64-bit, not as floating point.
            sums = np.zeros((2, n), np.int64)
            np.add.at(sums[0], row[near], times[near] * (value == highest[pair[near] // n_b]))
            np.add.at(sums[1], row[near], times[near] * value)
            far = ~near
            lists = [lists_of(row[far], n, pair[far]), lists_of(row[far], n, times[far])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:7]), pa.array(sums[0]), pa.array(sums[1]), *lists], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_row bigint, doc_id {kind}, {', '.join(f'{c} bigint' for c in _COUNTS)}, groups_sha256 string, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    summed = cut_lineage(found.mapInArrow(added, schema))
    cold = counts.filter(F.col("documents") * HOT_SHARE <= total).join(best.withColumnRenamed("a", "_a"), F.floor(F.col("pair") / n_b) == F.col("_a"))
    cold = cold.select("pair", "documents", (F.col("documents") == F.col("most")).alias("_top"))
    apart = summed.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_x")).select("_row", F.col("_x.pairs").alias("pair"), F.col("_x.times").alias("times"))
    more = apart.join(cold, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("_top"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("documents")).alias("_sum")
    )
    whole = summed.drop("pairs", "times").join(more, "_row", "left")
    n_best, count_sum = (F.col(c) + F.coalesce(F.col(m), F.lit(0)) for c, m in (("n_best", "_best"), ("count_sum", "_sum")))
    return whole.select("doc_id", *_COUNTS, n_best.alias("n_best"), count_sum.alias("count_sum"), "groups_sha256")

"""N-gram Jaccard join by T-occurrence search over inverted lists.

Documents are sets of word shingles. Equal sets are one class. The shingles of a class are
ordered by how frequent they are, rarest first, and its prefix is cut so long that two classes
of the wanted similarity share at least T shingles of their prefixes. A class searches the
inverted lists of its prefix: short lists are merged by a heap and counted, long lists are not
merged but probed by binary search for the candidates that the short ones leave (DivideSkip).
Candidates are verified on whole sets.

Frequencies are counts over all documents in a hashed table of fixed size. A cell's count is an
upper bound of each of its shingles' frequency, so a short list is short for certain.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded
from vecloom.llm.components import components, sized
from vecloom.llm.groups import attach
from vecloom.llm.shingles import SLICE_BYTES, set_digest, shingle_sets
from vecloom.session import cut_lineage

WORDS = 5
PERCENT = 80
CELLS_LOG2 = 23
SLICES = 64
#: A list is long beyond this, or beyond LONG_TIMES the mean count of a cell.
LONG = 64
LONG_TIMES = 8
LEADER_ROUNDS, LEADERS = 3, 4
#: Classes in a chunk whose lists are rows of bits, and classes that ask together there.
CHUNK, ASKING = 4096, 1024
#: Cells of the bitmap that tells which texts are read again: 1 MB.
BITMAP = 1 << 23


def least_overlap(n: Any, percent: int = PERCENT) -> Any:
    """Shingles that a set of ``n`` shares with any set of the wanted similarity."""
    return (percent * n + 99) // 100


def shared(n: int) -> int:
    """Shingles that two prefixes share, if the smaller set has ``n``: longer prefixes, fewer candidates."""
    return 1 + n // 20


def facts(docs: DataFrame, words: int, cells_log2: int) -> DataFrame:
    """One pass over the texts: (doc_id, text_hash, n, cid) of each row, and the tasks' parts of the frequency table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shift = np.uint64(64 - cells_log2)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cells = np.zeros(1 << cells_log2, np.uint32)
        id_type = None
        for batch in bounded(batches, "text", SLICE_BYTES):
            id_type = batch.column("doc_id").type
            sets = shingle_sets(batch.column("text"), words)
            np.add.at(cells, (np.concatenate(sets) >> shift).astype(np.int64), 1)
            empty = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) for s in sets], pa.int64()), empty, empty, pa.nulls(batch.num_rows, pa.binary())],
                names=names,
            )
        if id_type is not None:
            parts = cells.reshape(SLICES, -1)
            some = np.flatnonzero(parts.any(axis=1))
            blobs = [zstandard.compress(parts[s].tobytes(), 1) for s in some]
            k = len(some)
            task = pa.array([TaskContext.get().partitionId()] * k, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.nulls(k, id_type), *[pa.nulls(k, pa.int64())] * 3, pa.array(some, pa.int32()), task, pa.array(blobs, pa.binary())], names=names)

    names = ["doc_id", "text_hash", "n", "cid", "slice", "task", "cells"]
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return cut_lineage(texts.mapInArrow(scan, f"doc_id {kind}, text_hash bigint, n bigint, cid bigint, slice int, task int, cells binary"))


def frequency_cells(parts: DataFrame) -> dict[int, np.ndarray]:
    """The summed table by slice. Parts meet in two levels, so that no task sums more than about a square root of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for s, t, blob in zip(*(batch.column(c).to_pylist() for c in ("slice", "task", "cells")), strict=True):
                found = np.frombuffer(zstandard.decompress(blob), np.uint32)
                sums[s, t] = sums[s, t] + found if (s, t) in sums else found
        keys = list(sums)
        blobs = [zstandard.compress(sums[k].tobytes(), 1) for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "task", "cells"])

    schema = "slice int, task int, cells binary"
    tasks = parts.agg(F.max("task")).first()[0] or 0
    by_group = parts.withColumn("task", F.pmod("task", F.lit(max(1, math.isqrt(tasks + 1)))))
    some = by_group.repartition("slice", "task").mapInArrow(add, schema)
    found = some.withColumn("task", F.lit(0)).repartition("slice").mapInArrow(add, schema).select("slice", "cells").collect()
    return {r["slice"]: np.frombuffer(zstandard.decompress(r["cells"]), np.uint32) for r in found}


def weights(parts: DataFrame, cells_log2: int, long: int) -> np.ndarray:
    """One byte per cell: 0 where every list is short, else the number of bits of its count."""
    out = np.zeros(1 << cells_log2, np.uint8)
    cells = frequency_cells(parts)
    mean = sum(int(c.sum()) for c in cells.values()) / len(out)
    limit = max(long, math.ceil(LONG_TIMES * mean))
    size = len(out) // SLICES
    for s, counts in cells.items():
        out[s * size : (s + 1) * size] = np.where(counts > limit, np.ceil(np.log2(counts + 1.0)), 0)
    return out


def prefixes(docs: DataFrame, table: Any, words: int, percent: int, cells_log2: int) -> DataFrame:
    """One row per class: cid, n, its prefix as ``short`` and ``long`` (shingles in short and in long lists).

    A prefix that reaches the long lists has all of a set's shingles in short ones. For these
    sets ``n_long`` and ``long_key`` are size and digest of the rest, the set's long part.
    """
    shift = np.uint64(64 - cells_log2)
    lists = pa.list_(pa.int64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = table.value
        for batch in bounded(batches, "text", SLICE_BYTES):
            rows = []
            for found in shingle_sets(batch.column("text"), words):
                if n := len(found):
                    of = weight[(found >> shift).astype(np.int64)]
                    order = np.argsort(of, kind="stable")[: n - least_overlap(n, percent) + shared(n)]
                    chosen, heavy = found[order].astype(np.int64), of[order] > 0
                    rest = found[of > 0] if heavy.any() else found[:0]
                    rows.append((set_digest(found), n, chosen[~heavy], chosen[heavy], len(rest), set_digest(rest)))
            if rows:
                cid, n, short, long, n_long, long_key = zip(*rows, strict=True)
                columns = [pa.array(cid, pa.int64()), pa.array(n, pa.int64()), pa.array(short, lists), pa.array(long, lists), pa.array(n_long, pa.int64()), pa.array(long_key, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["cid", "n", "short", "long", "n_long", "long_key"])

    found = docs.select("text").mapInArrow(scan, "cid bigint, n bigint, short array<bigint>, long array<bigint>, n_long bigint, long_key bigint")
    return cut_lineage(found.dropDuplicates(["cid"]))


def _least_shared(n: Column, percent: int) -> Column:
    """T of a query: what its prefix shares with that of the smallest set similar to it."""
    return 1 + F.floor(F.ceil(n * percent / 100) / 20)


def short_lists(found: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """(q, need, list): for each class and shingle, the classes of smaller id in the shingle's list.

    Only short lists come here; rows are sorted by shingle and read as a stream that holds one
    list at a time. Sets of too different size are left out, and those that are in one
    component already.
    """
    t = _least_shared(F.col("n"), percent)
    need = F.greatest(F.lit(1), t - F.size("long")).cast("int")
    known = found.withColumn("label", F.lit(None).cast("bigint")) if labels is None else found.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    postings = known.select("cid", "n", "label", need.alias("need"), F.explode("short").alias("token"))
    names = ["q", "need", "list"]

    def runs(*columns: np.ndarray) -> pa.RecordBatch | None:
        order = np.lexsort((columns[1], columns[0]))
        token, cid, n, need, label = (c[order] for c in columns)
        at, partner = [], []
        k, here = 1, np.flatnonzero(token[1:] == token[:-1]) + 1
        while len(here):
            small, large = np.minimum(n[here], n[here - k]), np.maximum(n[here], n[here - k])
            good = here[(100 * small >= percent * large) & (label[here] != label[here - k])]
            at.append(good)
            partner.append(good - k)
            k += 1
            here = here[here >= k]
            here = here[token[here] == token[here - k]]
        if not at or not (total := sum(map(len, at))):
            return None
        rows, with_row = np.concatenate(at), np.concatenate(partner)
        order = np.lexsort((with_row, rows))
        rows, with_row = rows[order], with_row[order]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, total), pa.int32()), pa.array(cid[with_row]))
        own = rows[first]
        return pa.RecordBatch.from_arrays([pa.array(cid[own]), pa.array(need[own]), lists], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("token", "cid", "n", "need")]
            columns.append(pc.coalesce(batch.column("label"), batch.column("cid")).to_numpy())
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            last = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
            held = [c[last:] for c in columns]
            if last and (out := runs(*(c[:last] for c in columns))) is not None:
                yield out
        if held is not None and (out := runs(*held)) is not None:
            yield out

    return postings.repartition("token").sortWithinPartitions("token").mapInArrow(scan, "q bigint, need int, list array<bigint>")


def merge_short(lists: list[list[int]], need: int) -> list[tuple[int, int]]:
    """Heap-merge of sorted lists: the ids in at least ``need`` of them, with their number."""
    out, current, count = [], None, 0
    for x in heapq.merge(*lists):
        if x == current:
            count += 1
        else:
            if count >= need:
                out.append((current, count))
            current, count = x, 1
    if count >= need:
        out.append((current, count))
    return out


def probe_long(query: np.ndarray, candidate: np.ndarray) -> int:
    """How many of the query's long lists hold the candidate: binary search in the candidate's own sorted shingles."""
    if not len(query) or not len(candidate):
        return 0
    at = np.minimum(np.searchsorted(candidate, query), len(candidate) - 1)
    return int((candidate[at] == query).sum())


def candidates(found: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): pairs in different components that occur in T of their lists, among those that share a short list.

    Sizes known, a pair must occur in more lists than T: in as many as its overlap has
    shingles that cannot lie behind the prefixes.
    """
    grouped = short_lists(found, labels, percent).groupBy("q").agg(F.max("need").alias("need"), F.collect_list("list").alias("lists"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list[int], list[int], list[int]] = ([], [], [])
            for q, need, lists in zip(batch.column("q").to_pylist(), batch.column("need").to_pylist(), batch.column("lists"), strict=True):
                for c, count in merge_short(lists.as_py(), need):
                    out[0].append(q)
                    out[1].append(c)
                    out[2].append(count)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], names=["a", "b", "count"])

    pairs = cut_lineage(grouped.mapInArrow(search, "a bigint, b bigint, count int"))
    sizes = found.select("cid", "n", F.sort_array("long").alias("long"))

    def behind(n: Column) -> Column:
        """Shingles of a set that its prefix leaves out."""
        return F.ceil(n * percent / 100) - 1 - F.floor(n / 20)

    # All that two sets share and one prefix does not show lies behind that prefix.
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    shown = overlap - F.greatest(behind(F.col("n_a")), behind(F.col("n_b")))
    least = F.greatest(1 + F.floor(F.least("n_a", "n_b") / 20), shown)
    joined = (
        pairs.join(sizes.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("long").alias("long_a")), "a")
        .join(sizes.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("long").alias("long_b")), "b")
        .select("a", "b", "count", least.cast("int").alias("least"), "long_a", "long_b")
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, least = batch.column("count").to_numpy().copy(), batch.column("least").to_numpy()
            for i in np.flatnonzero(count < least).tolist():
                count[i] += probe_long(*(np.asarray(batch.column(c)[i].values) for c in ("long_a", "long_b")))
            keep = pa.array(count >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return joined.mapInArrow(probe, "a bigint, b bigint")


def whole_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cid, set) of the ``wanted`` classes, read again from one text of each.

    Texts are not joined: a bitmap of BITMAP cells, which the chosen texts' hashes are marked
    in, goes to all tasks, and only texts whose cell is marked are looked at. A text that is
    marked by chance leaves in the join by class.
    """
    chosen = rows.join(wanted, "cid", "left_semi").groupBy("cid").agg(F.min("text_hash").alias("text_hash"))
    cells = chosen.select(F.pmod("text_hash", F.lit(BITMAP)).cast("int").alias("cell")).distinct().toArrow()
    marked = np.zeros(BITMAP, bool)
    marked[cells.column("cell").to_numpy()] = True
    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))
    lists = pa.list_(pa.int64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bitmap.value).astype(bool)
        for whole in batches:
            few = whole.filter(pa.array(known[whole.column("cell").to_numpy()]))
            for batch in bounded(iter([few]), "text", SLICE_BYTES):
                sets = shingle_sets(batch.column("text"), words)
                yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in sets], pa.int64()), pa.array([s.astype(np.int64) for s in sets], lists)], names=["cid", "set"])

    texts = docs.select("text", F.pmod(F.xxhash64("text"), F.lit(BITMAP)).cast("int").alias("cell"))
    found = texts.mapInArrow(scan, "cid bigint, set array<bigint>").join(wanted, "cid", "left_semi")
    return cut_lineage(found.dropDuplicates(["cid"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def labelled(frame: DataFrame, labels: DataFrame | None, node: str, name: str) -> DataFrame:
    if labels is None:
        return frame.withColumn(name, F.col(node))
    joined = frame.join(labels.select(F.col("node").alias(node), F.col("label").alias(name)), node, "left")
    return joined.withColumn(name, F.coalesce(name, node))


def apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs that are not in one component yet."""
    return labelled(labelled(pairs, labels, "a", "_la"), labels, "b", "_lb").filter("_la <> _lb").select("a", "b")


def dense_pairs(postings: DataFrame, labels: DataFrame | None, seed: int, total: int) -> DataFrame:
    """For each class, the LEADERS leaders that most of its long lists name, if they are in other components.

    A list's leaders are the first of its classes by some hashes, so that a dense group has few.
    """
    ranks = [F.min_by("cid", F.xxhash64("cid", F.lit(seed * LEADERS + i))) for i in range(LEADERS)]
    leaders = postings.groupBy("token").agg(F.array_distinct(F.array(*ranks)).alias("leaders"), F.count(F.lit(1)).alias("group_size"))
    leaders = cut_lineage(sized(leaders.filter("group_size > 1"), total))
    named = attach(postings, leaders, "token", total).select("cid", F.explode("leaders").alias("leader")).filter("cid <> leader")
    pairs = named.groupBy("cid", "leader").agg(F.count(F.lit(1)).alias("k")).select(F.col("cid").alias("a"), F.col("leader").alias("b"), "k")
    open_pairs = labelled(labelled(pairs, labels, "a", "_la"), labels, "b", "_lb").filter("_la <> _lb")
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.col("k").desc(), "b"))
    return open_pairs.withColumn("nth", nth).filter(F.col("nth") <= LEADERS).select("a", "b")


def remaining_links(sets: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """The links (a, b) between classes of ``sets`` (cid, set) in different components, one per class and component in a chunk.

    Classes are dealt to chunks of about CHUNK and numbered there, so that a shingle's list in a
    chunk is a row of bits. A class adds up the bits of its lists: that is its overlap with
    every class of the chunk, from which similarity follows; nothing but links leaves the
    task. A shingle that one component alone holds is in no such overlap and left out.

    Who belongs to the component that holds most of a list need not ask for its sake: of two
    classes in different components, one at least is no such member in a list they share. It
    asks in all its lists, so its overlaps are whole.
    """
    sized_sets = labelled(sets.withColumn("n", F.size("set")), labels, "cid", "label")
    total = sets.count()
    chunks = max(1, -(-total // CHUNK))
    chunk = F.pmod(F.xxhash64("cid"), F.lit(chunks))
    place = F.row_number().over(Window.partitionBy("chunk").orderBy("cid")) - 1
    placed = cut_lineage(sized_sets.withColumn("chunk", chunk).withColumn("place", place))
    postings = placed.select("cid", "label", "chunk", "place", F.explode("set").alias("token"))
    counts = postings.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("token").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count(F.lit(1)).alias("n_labels"))
    main = cut_lineage(main.filter("n_labels > 1").drop("n_labels"))
    if main.isEmpty():
        return postings.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0)
    met = cut_lineage(postings.join(main, "token"))
    asking = cut_lineage(met.groupBy("cid").agg(F.bool_or(F.col("label") != F.col("main")).alias("asks")).filter("asks").select("cid"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for places in batch.column("places"):
                row = np.zeros(int(pc.max(places.values).as_py()) + 1, bool)
                row[places.values.to_numpy()] = True
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("chunk"), pa.array(bits, pa.binary())], names=["token", "chunk", "bits"])

    lists = met.groupBy("token", "chunk").agg(F.collect_list("place").alias("places")).mapInArrow(packed, "token bigint, chunk bigint, bits binary")
    asked = met.join(asking, "cid", "left_semi").select("token", F.col("cid").alias("a")).join(lists, "token")
    asked = asked.groupBy("a", "chunk").agg(F.collect_list("bits").alias("lists"))
    own = placed.select(F.col("cid").alias("a"), "n", "label")
    asked = asked.join(own, "a")
    # What a chunk's classes are goes ahead of the rows that ask there, to each part of them.
    parts = max(1, -(-asking.count() // ASKING))
    nothing = F.lit(None).cast("array<bigint>")
    members = placed.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("place", "cid", "n", "label"))).alias("m"))
    ahead = members.select("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"), F.lit(0).alias("kind"), *(F.col(f"m.{c}").cast("array<bigint>").alias(f"m_{c}") for c in ("cid", "n", "label")), F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("label"), F.lit(None).cast("array<binary>").alias("lists"))
    behind = asked.select("chunk", F.pmod(F.xxhash64("a"), F.lit(parts)).alias("part"), F.lit(1).alias("kind"), *(nothing.alias(f"m_{c}") for c in ("cid", "n", "label")), "a", F.col("n").cast("bigint").alias("n"), "label", "lists")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid = n = label = np.empty(0, np.int64)
        for batch in batches:
            out: tuple[list[int], list[int]] = ([], [])
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                if kind == 0:
                    cid, n, label = (batch.column(c)[i].values.to_numpy() for c in ("m_cid", "m_n", "m_label"))
                    continue
                overlap = np.zeros(len(cid), np.int64)
                for bits in batch.column("lists")[i].as_py():
                    row = np.unpackbits(np.frombuffer(bits, np.uint8))[: len(cid)]
                    overlap[: len(row)] += row
                mine, its_label = batch.column("n")[i].as_py(), batch.column("label")[i].as_py()
                good = np.flatnonzero((label != its_label) & (100 * overlap >= percent * (mine + n - overlap)))
                for j in good[np.unique(label[good], return_index=True)[1]].tolist():
                    out[0].append(batch.column("a")[i].as_py())
                    out[1].append(int(cid[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])

    rows = ahead.unionByName(behind).repartition("chunk", "part").sortWithinPartitions("chunk", "part", "kind")
    return rows.mapInArrow(search, "a bigint, b bigint")


def dense_classes(found: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of classes that long lists alone can link: the links among equal long parts, and the postings of who is still to be compared.

    Two classes that share no short list share just what their long parts share. So a class
    whose long part is too small a share of it has no such link. Classes of equal long part
    are similar if their other shingles together are few enough; then the one with the
    fewest is similar to both, and a star around it links what links. That needs no pairs.
    What is left to compare across long parts are these centres and the classes outside stars.
    """
    t = _least_shared(F.col("n"), percent)
    able = found.filter((F.size("long") >= t) & (100 * F.col("n_long") >= percent * F.col("n")))
    dense = cut_lineage(able.select("cid", "n", "n_long", "long_key", "long"))
    centres = dense.groupBy("long_key").agg(F.min(F.struct("n", "cid")).alias("centre"), F.count(F.lit(1)).alias("group_size"))
    total = dense.count()
    centres = centres.select("long_key", "centre.*", "group_size").toDF("long_key", "centre_n", "centre", "group_size")
    centres = cut_lineage(sized(centres, total))
    joined = attach(dense, centres, "long_key", total)
    close = 100 * F.col("n_long") >= percent * (F.col("n") + F.col("centre_n") - F.col("n_long"))
    judged = cut_lineage(sized(joined.withColumn("linked", close & (F.col("cid") != F.col("centre"))), total))
    links = judged.filter("linked").select(F.col("cid").alias("a"), F.col("centre").alias("b"))
    nodes = judged.filter("not linked").select("cid", "n", "n_long", "long_key", F.explode("long").alias("token"))
    return links, cut_lineage(nodes)


def classes_joined(docs: DataFrame, rows: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame | None:
    """(node, label) of the classes that have links, or None if there are none.

    Dense groups come first: stars of equal long parts, then leaders, as far as they link, then
    what links the components so far, by whole overlaps. Candidates from short lists are searched only across the components known by then, and of
    these each class is held against its first partner before the rest is verified. No pair
    that could link two components is left out.
    """
    links, nodes = dense_classes(found, percent)
    total = nodes.count()
    links = cut_lineage(sized(links, total))
    labels = None if links.isEmpty() else components(links)

    def add(new: DataFrame, most: int) -> bool:
        """Takes new links in, of which there are ``most`` at most."""
        nonlocal links, labels
        new = cut_lineage(sized(new, most))
        if new.isEmpty():
            return False
        links = links.unionByName(new)
        labels = components(links)
        return True

    if total:
        sets = whole_sets(docs, rows, nodes.select("cid").distinct(), words)
        for seed in range(LEADER_ROUNDS):
            if not add(verified(dense_pairs(nodes, labels, seed, total), sets, percent), total):
                break
        add(remaining_links(sets, labels, percent), total)
    pairs = cut_lineage(candidates(found, labels, percent))
    wanted = cut_lineage(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
    if wanted.isEmpty():
        return labels
    sets = whole_sets(docs, rows, wanted, words)
    most = pairs.count()
    add(verified(pairs.groupBy("a").agg(F.min("b").alias("b")), sets, percent), most)
    add(verified(apart(pairs, labels), sets, percent), most)
    return labels


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, cells_log2: int = CELLS_LOG2, long: int = LONG) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and a hash of its text.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets.
    ``component_id`` is the smallest doc_id that links reach, null ids last. Documents without
    words, null text included, link with nothing. Rows that repeat a doc_id each count by their
    own text. Extra columns are not read. Shingles and sets are told apart by 64-bit digests.
    """
    found = facts(docs, words, cells_log2)
    rows = found.filter("slice is null").select("doc_id", "text_hash", "n", "cid")
    table = docs.sparkSession.sparkContext.broadcast(weights(found.filter("slice is not null").select("slice", "task", "cells"), cells_log2, long))
    heads = prefixes(docs, table, words, percent, cells_log2)
    some = rows.filter("n > 0")
    labels = classes_joined(docs, some, heads, words, percent)
    classes = cut_lineage(some.groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("group_size")))
    if labels is None:
        groups = classes.withColumnRenamed("first_id", "component_id")
    else:
        marked = cut_lineage(classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left"))
        linked = marked.filter("label is not null")
        least = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
        grouped = linked.join(least, "label").select("cid", "component_id", "group_size")
        groups = grouped.unionByName(marked.filter("label is null").select("cid", F.col("first_id").alias("component_id"), "group_size"))
    groups = cut_lineage(groups)
    ended = attach(some, groups, "cid", rows.count()).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash")
    return ended.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents whose id is their component's, with all columns; the others leave by an anti-join.

    Rows that repeat an id and belong to one component stay or leave together. A null id stays
    only in a component of null ids, or without words.
    """
    gone = join(docs, words, percent).filter("not (doc_id <=> component_id)")
    gone = cut_lineage(gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")

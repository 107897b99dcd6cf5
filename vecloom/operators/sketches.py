"""SimHash and MinHash sketches of token lists, and near-duplicate search on them."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.binding import once
from vecloom.functions.sketching import minhash_of, simhash_of
from vecloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Classes of a bucket that are compared in one unit of work.
HOT_BUCKET = 256
LEADER_ROUNDS = 3
#: Rows of a bucket that are compared with each other at once.
FEW = 32
#: Classes of a block of a dense bucket, and of a tile that is compared at once.
DENSE_ROWS, TILE_ROWS = 1024, 256


def simhash(df: DataFrame, tokens: Column, id_column: str = "document_id", bit_length: int = 64) -> DataFrame:
    """(id, simhash) of every row; rows of equal id stay apart."""
    return df.select(id_column, simhash_of(tokens, bit_length).alias("simhash"))


def minhash(df: DataFrame, tokens: Column, id_column: str = "document_id", num_perm: int = 64, seed: int = 42) -> DataFrame:
    """(id, signature) of every row; rows of equal id stay apart."""
    return df.select(id_column, minhash_of(tokens, num_perm, seed).alias("signature"))


def jaccard_estimate(a: Column, b: Column) -> Column:
    """Share of equal positions; 0.0 for different or zero lengths."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    comparable = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(comparable, equal / F.greatest(F.size(a), F.lit(1))).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Positions:
    """A sketch as 64-bit words holding ``count`` positions of ``width`` bits each.

    Sketches that differ in at most ``allowed`` positions agree wholly on one block of
    any cut of the positions into ``allowed + 1`` blocks; that is what finds them.
    """

    count: int
    width: int
    allowed: int

    @property
    def words(self) -> list[str]:
        return [f"word{i}" for i in range(-(-self.count * self.width // 64))]

    def blocks(self, level: int) -> list[list[int]]:
        """Cut number ``level``: neighbours in the order p -> p*stride mod count share a block."""
        stride = next(s for s in range((1, 11, 27, 43)[level], 100) if math.gcd(s, self.count) == 1)
        order = sorted(range(self.count), key=lambda p: p * stride % self.count)
        cuts = [self.count * i // (self.allowed + 1) for i in range(self.allowed + 2)]
        return [order[a:b] for a, b in zip(cuts, cuts[1:])]

    def masks(self, block: list[int]) -> dict[str, int]:
        """The words that hold a block's positions, each with the bits of these."""
        masks = dict.fromkeys(self.words, 0)
        for p in block:
            masks[self.words[p * self.width // 64]] |= ((1 << self.width) - 1) << (p * self.width % 64)
        return {w: m - (1 << 64) if m >> 63 else m for w, m in masks.items() if m}

    def block_keys(self, level: int) -> Column:
        keys = [f"xxhash64({', '.join(f'{w} & {m}L' for w, m in self.masks(block).items())})" for block in self.blocks(level)]
        return F.expr(f"array({', '.join(keys)})")

    def digit(self, level: int, block: Column) -> Column:
        """A block of a cut as its digit of a bucket's ``path``; 0 stands for a cut that was not made."""
        return (block.cast("bigint") + 1) * (self.allowed + 2) ** level

    def lists(self, path: str, differ: str, levels: int = 3) -> Column:
        """Of all buckets that two classes share, only that of the first block they agree on, in every cut on its path, lists them.

        ``differ`` begins the names of the columns that hold the words' differing bits.
        """
        rules = []
        for level in range(levels):
            agree = [" AND ".join(f"{differ}{w} & {m}L = 0" for w, m in self.masks(block).items()) for block in self.blocks(level)]
            first = " ".join(f"WHEN {x} THEN {k}L" for k, x in enumerate(agree, 1))
            digit = f"({path} % {(self.allowed + 2) ** (level + 1)}L) div {(self.allowed + 2) ** level}L"
            rules.append(f"({digit} = 0 OR {digit} = CASE {first} ELSE 0L END)")
        return F.expr(" AND ".join(rules))

    def listed(self, path: np.ndarray, equal: np.ndarray, levels: int = 3) -> np.ndarray:
        """The same of pairs, from a row of ``path`` and of equal positions each."""
        out = np.ones(len(path), bool)
        for level in range(levels):
            digit = path // (self.allowed + 2) ** level % (self.allowed + 2)
            agree = np.stack([equal[:, block].all(axis=1) for block in self.blocks(level)], axis=1)
            out &= (digit == 0) | agree.any(axis=1) & (digit == agree.argmax(axis=1) + 1)
        return out

    def differing(self, left: str, right: str) -> Column:
        """Number of positions in which two aliased rows differ."""

        def count(word: str) -> str:
            x = f"({left}.{word} ^ {right}.{word})"
            if self.width == 1:
                return f"bit_count({x})"
            for shift in (4, 2, 1):  # fold the eight bits of each byte into its lowest one
                x = f"({x} | shiftrightunsigned({x}, {shift}))"
            return f"bit_count({x} & {0x0101010101010101}L)"

        return F.expr(" + ".join(count(w) for w in self.words))


def cut_buckets(classes: DataFrame, positions: Positions, hot: int = HOT_BUCKET, levels: int = 3) -> tuple[DataFrame, DataFrame | None]:
    """(bucket, path, id, words): classes within ``allowed`` of each other share a bucket.

    A bucket of more than ``hot`` classes is cut again if that at least halves the pairs to
    compare: a pair in it must also agree on a block of the next cut, so its rows move to the
    finer buckets (old bucket, block) and no pair is lost.  A group of classes that are near
    one another agrees on most blocks of any cut; it stays one bucket, as every further cut
    would only repeat it.  ``path`` tells the block of every cut that led to the bucket.
    Rows of buckets up to ``hot`` come first, then those of the larger ones that stay, with
    the bucket's ``size``, or None.  The list of hot buckets is counted with map-side
    combining and written out, as are their rows; without any, as usual, the first cut stands.
    """
    columns = ["id", *positions.words]

    def spread_out(rows: DataFrame, level: int) -> DataFrame:
        parent, path = (F.col(c) if level else F.lit(0).cast("bigint") for c in ("bucket", "path"))
        keyed = rows.select(parent.alias("parent"), path.alias("path"), *columns, F.posexplode(positions.block_keys(level)).alias("block", "key"))
        bucket = F.xxhash64("parent", F.lit(level), "block", "key").alias("bucket")
        return keyed.select(bucket, (F.col("path") + positions.digit(level, F.col("block"))).alias("path"), *columns, "parent")

    rows, few, dense = spread_out(classes, 0).drop("parent"), [], []
    for level in range(1, levels + 1):
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
        crowded = cut_lineage(sizes.filter(F.col("size") > hot))
        if crowded.isEmpty():
            few.append(rows)
            break
        few.append(rows.join(crowded, "bucket", "left_anti"))
        large = cut_lineage(rows.join(crowded, "bucket").select(*rows.columns, "size"))
        if level == levels:
            dense.append(large)
            break
        finer = spread_out(large, level).groupBy("parent", "bucket").agg(F.count(F.lit(1)).cast("double").alias("n"))
        met = finer.groupBy(F.col("parent").alias("bucket")).agg(F.sum(F.col("n") * F.col("n")).alias("met"))
        thinner = crowded.join(met, "bucket").filter(2 * F.col("met") <= F.col("size").cast("double") * F.col("size"))
        thinner = cut_lineage(thinner.select("bucket"))
        dense.append(large.join(thinner, "bucket", "left_anti"))
        if thinner.isEmpty():
            break
        rows = spread_out(large.join(thinner, "bucket", "left_semi"), level).drop("parent")
    return reduce(DataFrame.unionByName, few), reduce(DataFrame.unionByName, dense) if dense else None


def bucketed(classes: DataFrame, positions: Positions, hot: int = HOT_BUCKET, levels: int = 3) -> DataFrame:
    """(bucket, id, words) of all buckets of ``cut_buckets``."""
    few, dense = cut_buckets(classes, positions, hot, levels)
    columns = ["bucket", "id", *positions.words]
    return few.select(columns) if dense is None else few.select(columns).unionByName(dense.select(columns))


def units(buckets: DataFrame, limit: int = HOT_BUCKET) -> DataFrame:
    """Buckets as units of work: a bucket over ``limit`` becomes blocks of about that size, and its units are the pairs of blocks.

    Adds ``unit``, ``block`` and ``lone``. Two rows of a bucket meet in the unit of their two
    blocks; rows of one block only in that block's ``lone`` unit. So no unit holds more than
    about ``2 * limit`` rows, and every pair is met.
    """
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    dense = cut_lineage(sizes.filter(F.col("size") > limit).select("bucket", F.ceil(F.col("size") / limit).alias("blocks")))
    whole = (F.xxhash64("bucket").alias("unit"), F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("lone"))
    if dense.isEmpty():
        return buckets.select("*", *whole)
    easy = buckets.join(dense, "bucket", "left_anti").select(*buckets.columns, *whole)
    cut = buckets.join(dense, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    unit = F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))
    hard = met.select(*buckets.columns, unit.alias("unit"), "block", (F.col("block") == F.col("other")).alias("lone"))
    return easy.unionByName(hard)


def _together(a: str, b: str) -> Column:
    """Two rows meet in this unit and in no other of their bucket."""
    same = (F.col(f"{a}.unit") == F.col(f"{b}.unit")) & (F.col(f"{a}.bucket") == F.col(f"{b}.bucket"))
    return same & ((F.col(f"{a}.block") != F.col(f"{b}.block")) | (F.col(f"{a}.lone") & F.col(f"{b}.lone")))


def candidate_pairs(buckets: DataFrame, positions: Positions, limit: int = HOT_BUCKET) -> DataFrame:
    """Distinct (id_a, id_b), id_a < id_b, whose sketches differ in at most ``allowed`` positions."""
    met = units(buckets, limit)
    close = _together("a", "b") & (F.col("a.id") < F.col("b.id")) & (positions.differing("a", "b") <= positions.allowed)
    return met.alias("a").join(met.alias("b"), close).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


def _simhash_classes(fingerprints: DataFrame, id_column: str) -> DataFrame:
    return fingerprints.groupBy("simhash").agg(F.min(id_column).alias("id"), F.count("*").alias("copies"))


def _minhash_classes(signatures: DataFrame, id_column: str) -> DataFrame:
    return signatures.groupBy("signature").agg(F.min(id_column).alias("id"), F.count("*").alias("copies"))


def _simhash_positions(max_distance: int) -> Positions:
    return Positions(count=64, width=1, allowed=max_distance)


def _needed(num_perm: int, threshold: float) -> int:
    """Equal positions that make the estimate reach the threshold."""
    return math.ceil(round(threshold * num_perm, 9))


def _minhash_positions(num_perm: int, threshold: float) -> Positions:
    return Positions(count=num_perm, width=8, allowed=num_perm - _needed(num_perm, threshold))


def _minhash_words(classes: DataFrame, positions: Positions) -> DataFrame:
    """Keep the low byte of each signature value, eight to a word: equal values have equal bytes."""
    words = []
    for i, name in enumerate(positions.words):
        bytes_ = [f"shiftleft(signature[{8 * i + j}] & 255L, {8 * j})" for j in range(min(8, positions.count - 8 * i))]
        words.append(F.expr(" | ".join(bytes_)).alias(name))
    return classes.select("id", *words)


def representatives(sketches: DataFrame, sketch_column: str, id_column: str = "document_id") -> DataFrame:
    """(id, representative): the smallest id with the same sketch.

    Sketches of more than a thousandth of the rows are fewer than a thousand: these are
    broadcast, and their rows (all texts without tokens, say) do not meet in one task.
    """
    rows = cut_lineage(sketches.select(id_column, sketch_column))
    smallest = cut_lineage(rows.groupBy(sketch_column).agg(F.min(id_column).alias("representative"), F.count(F.lit(1)).alias("copies")))
    total = rows.count()
    often = smallest.filter(F.col("copies") * 1000 > total)
    met = rows.join(F.broadcast(often), sketch_column)
    rest = rows.join(F.broadcast(often.select(sketch_column)), sketch_column, "left_anti")
    rest = rest.join(smallest.filter(F.col("copies") * 1000 <= total), sketch_column)
    return met.unionByName(rest).select(id_column, "representative")


def simhash_pairs(
    fingerprints: DataFrame, max_distance: int = 3, id_column: str = "document_id", hot: int = HOT_BUCKET
) -> DataFrame:
    """All pairs of distinct fingerprints at most ``max_distance`` bits apart.

    Documents with the same fingerprint are one class, named by its smallest id, with the
    number of its ``copies``; ``representatives`` lists the members.  A group of n copies
    thus stays one row instead of n*(n-1)/2 pairs.
    """
    positions = _simhash_positions(max_distance)
    classes = cut_lineage(_simhash_classes(fingerprints, id_column))
    pairs = candidate_pairs(bucketed(classes.withColumn("word0", F.col("simhash")), positions, hot), positions, hot)
    a = classes.select(F.col("id").alias("id_a"), F.col("simhash").alias("hash_a"), F.col("copies").alias("copies_a"))
    b = classes.select(F.col("id").alias("id_b"), F.col("simhash").alias("hash_b"), F.col("copies").alias("copies_b"))
    distance = F.bit_count(F.col("hash_a").bitwiseXOR(F.col("hash_b"))).alias("hamming")
    return pairs.join(a, "id_a").join(b, "id_b").select("id_a", "id_b", "copies_a", "copies_b", distance)


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float, *more: str) -> DataFrame:
    """Pairs whose whole signatures reach the threshold, with the estimate and ``more`` columns of both classes."""

    def side(name: str) -> DataFrame:
        return classes.select(*[F.col(c).alias(f"{c}_{name}") for c in ("id", "signature", "copies", *more)])

    estimate = jaccard_estimate(F.col("signature_a"), F.col("signature_b")).alias("jaccard")
    both = [f"{c}_{name}" for c in ("id", "copies", *more) for name in "ab"]
    return pairs.join(side("a"), "id_a").join(side("b"), "id_b").select(*both, estimate).filter(F.col("jaccard") >= threshold)


def _named(pairs: DataFrame) -> DataFrame:
    """Pairs of numbered classes by the classes' ids, the smaller one first; classes of equal id make no pair."""
    ahead = F.col("name_a") < F.col("name_b")
    copies = [F.when(ahead, F.col(f"copies_{x}")).otherwise(F.col(f"copies_{y}")).alias(f"copies_{x}") for x, y in ("ab", "ba")]
    ids = [F.least("name_a", "name_b").alias("id_a"), F.greatest("name_a", "name_b").alias("id_b")]
    return pairs.filter(F.col("name_a") != F.col("name_b")).select(*ids, *copies, "jaccard")


def _few_pairs(few: DataFrame, positions: Positions) -> DataFrame:
    """(id_a, id_b), each pair once: classes of a bucket that differ in at most ``allowed`` positions."""
    same = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.path") == F.col("b.path"))
    near = positions.differing("a", "b") <= positions.allowed
    met = few.alias("a").join(few.alias("b"), same & (F.col("a.id") < F.col("b.id")) & near)
    differ = [F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}")).alias(f"differ_{w}") for w in positions.words]
    met = met.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), F.col("a.path").alias("path"), *differ)
    return once(met, listed=positions.lists("path", "differ_")).filter("listed").select("id_a", "id_b")


def _dense_pairs(dense: DataFrame, classes: DataFrame, positions: Positions, threshold: float) -> DataFrame:
    """The pairs of dense buckets with their estimate: whole signatures of two blocks meet in one task, tile by tile."""
    named = dense.select("bucket", "path", F.col("id").alias("class"), F.ceil(F.col("size") / DENSE_ROWS).alias("blocks"))
    named = named.join(classes, "class").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    met = named.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    least, count = positions.count - positions.allowed, positions.count

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = pa.Table.from_batches(batches).combine_chunks()
        ids, copies, path = met["id"].combine_chunks(), met["copies"].combine_chunks(), met["path"].to_numpy()
        rank = pc.rank(ids, tiebreaker="dense").to_numpy()
        values = met["signature"].combine_chunks().flatten().to_numpy().reshape(-1, count)
        columns, low_bytes = np.ascontiguousarray(values.T), (values & 255).astype(np.uint8)
        block, low, high = (met[c].to_numpy() for c in ("block", "low", "high"))
        lower, upper = np.flatnonzero(block == low), np.flatnonzero(block == high)
        alone = low[0] == high[0]
        for i in range(0, len(lower), TILE_ROWS):
            for j in range(i if alone else 0, len(upper), TILE_ROWS):
                x, y = lower[i : i + TILE_ROWS], upper[j : j + TILE_ROWS]
                equal = np.zeros((len(x), len(y)), np.int32)
                for column in columns:
                    equal += column[x][:, None] == column[y]
                near = (equal >= least) & (equal / count >= threshold) & (path[x][:, None] == path[y]) & (rank[x][:, None] != rank[y])
                if alone and i == j:
                    near = np.triu(near, 1)
                at_x, at_y = np.nonzero(near)
                a, b, share = x[at_x], y[at_y], equal[at_x, at_y] / count
                keep = positions.listed(path[a], low_bytes[a] == low_bytes[b])
                a, b, share = a[keep], b[keep], share[keep]
                ahead = rank[a] < rank[b]
                a, b = (pa.array(np.where(ahead, *z)) for z in ((a, b), (b, a)))
                columns_ = [ids.take(a), ids.take(b), copies.take(a), copies.take(b), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns_, names=["id_a", "id_b", "copies_a", "copies_b", "jaccard"])

    kind = classes.schema["id"].dataType.simpleString()
    schema = f"id_a {kind}, id_b {kind}, copies_a bigint, copies_b bigint, jaccard double"
    return met.drop("other", "blocks", "class").groupBy("bucket", "low", "high").applyInArrow(pairs, schema)




def minhash_pairs(
    signatures: DataFrame,
    threshold: float = 0.8,
    id_column: str = "document_id",
    num_perm: int = 64,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """All pairs of distinct signatures whose Jaccard estimate reaches ``threshold``.

    The number of bands follows from the threshold (one more than the positions that may
    differ), so banding finds every such pair.  Buckets carry one byte per position; the
    few pairs that pass are checked on the whole signatures.  Dense buckets, whose pairs are
    many, are given these at once.  A pair is listed by one of the buckets it shares.
    """
    positions = _minhash_positions(num_perm, threshold)
    # ids may repeat, so classes have numbers; without an id a class is in no pair
    classes = _minhash_classes(signatures, id_column).filter(F.col("id").isNotNull() & F.col("signature").isNotNull())
    classes = cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()))
    words = _minhash_words(classes.select(F.col("class").alias("id"), "signature"), positions)
    few, dense = cut_buckets(words, positions, hot)
    found = _named(_estimated(_few_pairs(few, positions), classes.withColumnsRenamed({"id": "name", "class": "id"}), threshold, "name"))
    return found if dense is None else found.unionByName(_dense_pairs(dense, classes, positions, threshold))


def _survivors(classes: DataFrame, sketches: DataFrame, positions: Positions, hot: int, confirm) -> DataFrame:
    """Ids of classes without a smaller-id class in reach, never listing all pairs of a dense group.

    Buckets of up to FEW (at most ``hot``) rows are compared at once. In larger ones each row first meets only
    the smallest id of its bucket, then the next one, which settles the members of a dense
    group at one comparison each; only rows that stay open after LEADER_ROUNDS meet the rest
    of their buckets, in units of bounded size. ``confirm`` keeps the (id_a, id_b) that really
    are near.
    """
    buckets = cut_lineage(bucketed(sketches, positions, hot))
    near = positions.differing("a", "b") <= positions.allowed
    smaller = F.col("a.id") < F.col("b.id")
    same = F.col("a.bucket") == F.col("b.bucket")
    ids = [F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")]
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > min(FEW, hot))
    crowded = cut_lineage(crowded.select("bucket"))
    dense = not crowded.isEmpty()
    small = buckets.join(crowded, "bucket", "left_anti") if dense else buckets
    pairs = small.alias("a").join(small.alias("b"), same & smaller & near).select(*ids).distinct()
    dropped = confirm(pairs).select(F.col("id_b").alias("id"))
    if not dense:
        return classes.select("id").join(dropped, "id", "left_anti")

    settled = cut_lineage(dropped.distinct())
    large = cut_lineage(buckets.join(crowded, "bucket", "left_semi"))
    leading = large
    for _ in range(LEADER_ROUNDS):
        first = leading.groupBy("bucket").agg(F.min(F.struct("id", *positions.words)).alias("first")).select("bucket", "first.*")
        still_open = large.join(settled, "id", "left_anti")
        by_first = first.alias("a").join(still_open.alias("b"), same & smaller & near).select(*ids)
        found = cut_lineage(confirm(by_first.distinct()).select(F.col("id_b").alias("id")).distinct())
        if found.isEmpty():
            break
        settled = cut_lineage(settled.unionByName(found))
        # who has led its bucket does not lead it again
        leading = leading.join(first.select("bucket", "id"), ["bucket", "id"], "left_anti")
    met = units(large, hot)
    asking = met.join(settled, "id", "left_anti")
    by_others = met.alias("a").join(asking.alias("b"), _together("a", "b") & smaller & near).select(*ids).distinct()
    dropped = settled.unionByName(confirm(by_others).select(F.col("id_b").alias("id")))
    return classes.select("id").join(dropped, "id", "left_anti")


def near_dedup(
    df: DataFrame,
    sketches: DataFrame,
    method: str = "simhash",
    max_distance: int = 3,
    threshold: float = 0.8,
    id_column: str = "document_id",
    num_perm: int = 64,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """Rows of ``df`` without a near-duplicate of smaller id (single hop).

    ``sketches`` is the result of ``simhash`` or ``minhash`` for the same ids.  Equal
    sketches keep only their smallest id, so the search runs on classes.
    """
    if method == "simhash":
        positions = _simhash_positions(max_distance)
        classes = cut_lineage(_simhash_classes(sketches, id_column))
        words = classes.select("id", F.col("simhash").alias("word0"))
        kept = _survivors(classes, words, positions, hot, lambda pairs: pairs)
    elif method == "minhash":
        classes = cut_lineage(_minhash_classes(sketches, id_column))
        positions = _minhash_positions(num_perm, threshold)
        words = _minhash_words(classes, positions)
        kept = _survivors(classes, words, positions, hot, lambda pairs: _estimated(pairs, classes, threshold))
    else:
        raise ValueError(f"unknown method: {method}")
    return df.join(kept.withColumnRenamed("id", id_column), id_column, "left_semi")

"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity; the rarest ones are a line's
prefix, and two lines of the wanted similarity share a word of their prefixes. Pairs that meet
on such a word pass the length filter, the positional filter (how much can still be shared
from here on) and a bitmap filter (parities of the words differ in no more places than words
may differ), and are then verified on their whole sets. A line goes if an equal or similar
line stands earlier, by doc_id and line number.

Lines of equal word sets are one class throughout: classes meet, not lines. Where many classes
share three words that stand first in hash order, they may be one family: each is held against
the group's earliest class before any pair is listed. What an earlier class settles so asks for
no pairs any more, but still answers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.groups import attach
from vecloom.session import cut_lineage

PERCENT = 80
CELLS = 1 << 16
BITMAP = 1 << 20
#: Cells for the lines that the verification reads again.
LINE_BITMAP = 1 << 22
#: From so many words on, a line has 128 parities.
WIDE = 40
#: Groups of more classes than this are held against their earliest before pairs are listed.
FAMILY = 64
#: Smaller sets have no bands: those that differ in a word are hardly similar.
LEAST_BANDED = 8
_SPACE = "[\\x20\\x09-\\x0D]+"
_OTHER_SPACE = "[\\x09\\x0B-\\x0D]"
_KEEP_BITS = 55


def _words(line: Column) -> Column:
    """Words of a line. A split at one plain character needs no pattern, which takes a third of the time."""
    return F.array_remove(F.when(line.rlike(_OTHER_SPACE), F.split(line, _SPACE)).otherwise(F.split(line, " ")), "")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, words) of all lines of whole texts; null is one empty line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    return lines.select("doc_id", "text_hash", "line_no", _words(F.col("line")).alias("words"))


def _cell(digest: Column) -> Column:
    return digest.bitwiseAND(F.lit(CELLS - 1)).cast("int")


def rarity(docs: DataFrame) -> Column:
    """Weight of each of CELLS word cells as an array: the logarithm of its count over all documents.

    One row per cell reaches the driver, whatever the corpus. Words of one cell share a
    weight; any order of words that all lines use keeps the join exact.
    """
    words = docs.select(F.explode(_words(F.replace("text", F.lit("\n"), F.lit(" ")))).alias("word"))
    counts = words.groupBy(_cell(F.xxhash64("word")).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    table = [0] * CELLS
    for r in counts:
        table[r["cell"]] = min(255, int(8 * math.log2(r["n"])))
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def line_sets(lines: DataFrame, table: Column) -> DataFrame:
    """``lines`` with ``tokens``: each distinct word as its weight and 55 bits of its digest, rarest first."""

    def packed(digest: Column) -> Column:
        weight = F.shiftleft(F.get(table, _cell(digest)).cast("bigint"), _KEEP_BITS)
        return weight.bitwiseOR(F.shiftrightunsigned(digest, 64 - _KEEP_BITS))

    digests = F.array_distinct(F.transform("words", lambda word: F.xxhash64(word)))
    tokens = F.sort_array(F.transform(digests, packed))
    found = lines.select("doc_id", "text_hash", "line_no", tokens.alias("tokens"))
    return found.withColumn("key", F.xxhash64("tokens")).withColumn("n", F.size("tokens"))


def _parities(tokens: Column) -> Column:
    """64 parities of words: bit b tells whether an odd number of them fall on b."""

    def flip(bits: Column, token: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), token.bitwiseAND(F.lit(63)).cast("int"))
        return bits.bitwiseXOR(one)

    return F.aggregate(tokens, F.lit(0).cast("bigint"), flip)


def _odd() -> Column:
    """The parities of the words on one half of 128 bits, which longer lines need; those of all words give the other half."""
    half = F.filter("tokens", lambda t: t.bitwiseAND(F.lit(64)) != 0)
    return F.when(F.col("n") >= WIDE, _parities(half)).otherwise(0)


def _bands() -> Column:
    """Four hashes of three words each, from both ends of the rarer half in hash order: near copies share one or more.

    They only tell which classes are tried first.
    """
    rare = F.slice("tokens", F.lit(1), F.ceil(F.col("n") / 2).cast("int"))
    drawn = F.sort_array(F.transform(rare, lambda t: t.bitwiseAND(F.lit((1 << _KEEP_BITS) - 1))))
    # Bound once: each band would sort the words again.
    return F.element_at(F.transform(F.array(drawn), lambda u: F.array(*[F.hash(F.slice(u, k, 3)) for k in (1, 2, -3, -4)])), 1)


def cells_for(rows: DataFrame, most: int = BITMAP) -> int:
    """Cells of a bitmap in which few others are marked by chance, ``most`` at most: plans hold it."""
    return min(most, 1 << max(12, (4 * rows.count()).bit_length()))


def marks(hashes: DataFrame, name: str, size: int = BITMAP) -> Callable[[Column], Column]:
    """Test of a 64-bit hash against a bitmap of ``size`` cells in which all ``hashes`` are marked.

    What reaches the driver and the tasks has that size at most, whatever the corpus. Hashes
    may be marked by chance, so a join must follow; it gets less to shuffle.
    """
    cells = hashes.select(F.pmod(name, F.lit(size)).cast("int").alias("cell")).distinct().toArrow().column("cell").to_pylist()
    words = [0] * (size // 16)
    for cell in cells:
        words[cell >> 4] |= 1 << (cell & 15)
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<int>")

    def test(value: Column) -> Column:
        cell = F.pmod(value, F.lit(size)).cast("int")
        bit = F.call_function("shiftright", F.get(table, F.shiftright(cell, 4)), cell.bitwiseAND(F.lit(15)))
        return bit.bitwiseAND(F.lit(1)) == 1

    return test


def least_overlap(n_a: Column, n_b: Column, percent: int) -> Column:
    """Words that two sets of these sizes share if they are similar."""
    return F.call_function("div", percent * (n_a + n_b) + 99 + percent, F.lit(100 + percent))


def classes_of(lines: DataFrame) -> DataFrame:
    """One row per word set: key, n, its number of lines, where it stands first, its prefix and parities.

    Most sets stand once: those pass as they are, and only keys that may repeat are grouped.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line_no")
    kept = ("n", "prefix", "low", "odd", "bands")
    often = marks(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key")
    once = lines.filter(~often(F.col("key"))).select("key", place.alias("first"), F.lit(1).cast("bigint").alias("group_size"), *kept)
    again = lines.filter(often(F.col("key"))).groupBy("key")
    again = again.agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("group_size"), *[F.first(c).alias(c) for c in kept])
    return once.unionByName(cut_lineage(again))


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, met): keys of classes that share a prefix word and pass all filters, and on how many words they met.

    The first word that two sets share has as many words after it, in either set, as they must
    share; a word further back in a prefix does not count for the pair. Pairs of two classes
    that are not ``open`` are left out.
    """
    # Words that share 32 bits of their hash meet too, which costs a test and loses nothing.
    facts = F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.shiftleft(F.col("at").cast("bigint"), 1)).bitwiseOR(F.col("open").cast("bigint"))
    posted = classes.select("key", "n", "open", "low", "odd", F.posexplode("prefix").alias("at", "token")).select("token", "key", facts.alias("facts"), "low", "odd")
    # Both sides are the same rows, so that they are shuffled once.
    a, b = (posted.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "facts", "low", "odd")]) for side in "ab")
    n_a, n_b = (F.shiftright(f"facts_{side}", 32) for side in "ab")
    at_a, at_b = (F.shiftright(F.col(f"facts_{side}").bitwiseAND(F.lit((1 << 32) - 1)), 1) for side in "ab")
    open_ = F.col("facts_a").bitwiseOR(F.col("facts_b")).bitwiseAND(F.lit(1)) == 1
    least = least_overlap(n_a, n_b, percent)
    may_differ = n_a + n_b - 2 * least
    once = (n_a < n_b) | ((n_a == n_b) & (F.col("key_a") < F.col("key_b")))
    length = 100 * n_a >= percent * n_b
    front = (n_a - at_a >= least) & (n_b - at_b >= least)
    position = F.least(at_a, at_b) + F.least(n_a - at_a, n_b - at_b) >= least
    low, odd = (F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")) for c in ("low", "odd"))
    wide = (n_a < WIDE) | (F.bit_count(odd) + F.bit_count(low.bitwiseXOR(odd)) <= may_differ)
    met = a.join(b, "token").filter(once & length & open_ & (F.bit_count(low) <= may_differ) & wide & front & position)
    return cut_lineage(met.groupBy(F.col("key_a").alias("a"), F.col("key_b").alias("b")).agg(F.count(F.lit(1)).alias("met")))


def sets_of(docs: DataFrame, table: Column, firsts: DataFrame) -> DataFrame:
    """(key, tokens) of the classes in ``firsts``, whose lines are cut out of the texts again.

    Texts do not move: bitmaps of the wanted texts and lines leave few others, which the join drops.
    """
    texts = marks(firsts.select(F.col("first.text_hash").alias("text_hash")), "text_hash", cells_for(firsts))
    wanted = marks(firsts.select(F.xxhash64("first.text_hash", "first.line_no").alias("place")), "place", cells_for(firsts, LINE_BITMAP))
    lines = docs.filter(texts(F.xxhash64("text"))).select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.filter(wanted(F.xxhash64("text_hash", "line_no")))
    lines = lines.select("doc_id", "text_hash", "line_no", _words(F.col("line")).alias("words"))
    sets = line_sets(lines, table).select("key", "tokens").join(firsts.select("key"), "key", "left_semi")
    return sets.dropDuplicates(["key"])


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key) of ``pairs`` (key, earlier) whose word sets are similar."""
    own = sets.withColumnRenamed("tokens", "own")
    other = sets.select(F.col("key").alias("earlier"), F.col("tokens").alias("other"))
    common = F.size(F.array_intersect("own", "other"))
    similar = 100 * common >= percent * (F.size("own") + F.size("other") - common)
    return cut_lineage(pairs.join(other, "earlier").join(own, "key").filter(similar).select("key").distinct())


def families(docs: DataFrame, table: Column, classes: DataFrame, percent: int) -> DataFrame | None:
    """(key) of classes that are similar to the earliest class of a large group with a common band; None without such groups.

    A class is held against one class a band, so the work grows with the classes.
    """
    bands = classes.filter(F.col("n") >= LEAST_BANDED).select("key", F.col("first.doc_id").alias("at"), F.explode("bands").alias("band"))
    heads = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min_by("key", "at").alias("earlier"))
    heads = cut_lineage(heads.filter((F.col("members") > FAMILY) & F.col("earlier").isNotNull()).select("band", "earlier"))
    if heads.isEmpty():
        return None
    tried = cut_lineage(bands.join(heads, "band").filter("key <> earlier").select("key", "earlier").distinct())
    firsts = cut_lineage(classes.select("key", "first").join(tried.select("key").union(tried.select("earlier")).distinct(), "key", "left_semi"))
    sets = cut_lineage(sets_of(docs, table, firsts))
    before = firsts.select(F.col("key").alias("earlier"), F.col("first").alias("first_earlier"))
    tried = tried.join(before, "earlier").join(firsts, "key").filter(F.col("first_earlier") < F.col("first")).select("key", "earlier")
    return alike(tried, sets, percent)


def opened(classes: DataFrame, settled: DataFrame | None) -> DataFrame:
    """``classes`` with ``open``: whether no earlier class has settled it. Only keys that may be settled are joined."""
    if settled is None:
        return classes.withColumn("open", F.lit(True))
    maybe = marks(settled, "key", cells_for(settled))
    some = cut_lineage(classes.filter(maybe(F.col("key"))))
    still = classes.filter(~maybe(F.col("key"))).unionByName(some.join(settled, "key", "left_anti"))
    return still.withColumn("open", F.lit(True)).unionByName(some.join(settled, "key", "left_semi").withColumn("open", F.lit(False)))


def similar_classes(docs: DataFrame, table: Column, classes: DataFrame, percent: int) -> DataFrame:
    """(key) of classes that a similar class precedes.

    One earlier partner is enough, so classes of large groups are first held against the
    group's earliest, and each class that stays open against the one it met on most words.
    Only classes that are open then meet all their earlier partners.
    """
    known = families(docs, table, classes, percent)
    pairs = candidates(opened(classes, known), percent)
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    wanted = cut_lineage(wanted)
    firsts = cut_lineage(classes.join(wanted, "key", "left_semi").select("key", "first"))
    a, b = (firsts.select(F.col("key").alias(side), F.col("first").alias(f"first_{side}")) for side in "ab")
    late = F.col("first_a") > F.col("first_b")
    ordered = pairs.join(a, "a").join(b, "b")
    ordered = ordered.select(F.when(late, F.col("a")).otherwise(F.col("b")).alias("key"), F.when(late, F.col("b")).otherwise(F.col("a")).alias("earlier"), "met")
    if known is not None:
        ordered = ordered.join(known, "key", "left_anti")
    ordered = cut_lineage(ordered)
    sets = cut_lineage(sets_of(docs, table, firsts))
    settled = alike(ordered.groupBy("key").agg(F.max_by("earlier", "met").alias("earlier")), sets, percent)
    rest = alike(ordered.join(settled, "key", "left_anti").select("key", "earlier"), sets, percent)
    found = settled.unionByName(rest)
    return found if known is None else found.unionByName(known)


def decide(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_hash, n_lines, n_removed, removed (line numbers from 0).

    Lines without words stay. A line goes if an earlier one has the same words, whatever their
    order and number, or ``100 * intersection >= percent * union``; that the earlier one may go
    itself does not matter. Earlier is by doc_id, null ids last, then text hash and line
    number. Rows that repeat id and text are one document here.
    """
    table = rarity(docs)
    prefix = F.slice("tokens", F.lit(1), F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1)
    sets = line_sets(lines_of(docs), table)
    facts = sets.select("doc_id", "text_hash", "line_no", "key", "n", F.transform(prefix, lambda t: F.hash(t)).alias("prefix"), _parities(F.col("tokens")).alias("low"), _odd().alias("odd"), F.when(F.col("n") >= LEAST_BANDED, _bands()).alias("bands"))
    lines = cut_lineage(facts)
    some = lines.filter("n > 0")
    classes = classes_of(some)
    near = similar_classes(docs, table, classes, percent)
    # Lines of other classes stay and are not joined.
    maybe = marks(near, "key", cells_for(near))
    marked = classes.filter((F.col("group_size") > 1) | maybe(F.col("key"))).select("key", "first", "group_size")
    marked = cut_lineage(marked.join(near.withColumn("near", F.lit(True)), "key", "left"))
    may_go = marks(marked, "key", cells_for(marked))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line_no")
    held = cut_lineage(some.select("doc_id", "text_hash", "line_no", "key").filter(may_go(F.col("key"))))
    judged = attach(held, marked, "key", lines.count())
    gone = judged.select("doc_id", "text_hash", F.when(F.col("near").isNotNull() | (place > F.col("first")), F.col("line_no")).alias("gone"))
    every = lines.filter("line_no = 0").select("doc_id", "text_hash", F.lit(None).cast("int").alias("gone"))
    found = gone.filter("gone is not null").unionByName(every).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("gone")).alias("removed"))
    count = lines.groupBy("doc_id", "text_hash").agg((F.max("line_no") + 1).cast("bigint").alias("n_lines"))
    same = F.col("l.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("l.text_hash") == F.col("f.text_hash"))
    joined = count.alias("l").join(found.alias("f"), same)
    return joined.select("l.doc_id", "l.text_hash", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), "removed")


def remove_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without the lines that go, all other columns as they were."""
    gone = cut_lineage(decide(docs, percent).filter("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("removed").alias("_removed")))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left")

    def between(k: Column) -> Column:
        start = F.when(k > 0, F.get("_removed", k - 1) + 1).otherwise(0)
        end = F.when(k < F.size("_removed"), F.get("_removed", k)).otherwise(F.size("_lines"))
        return F.slice("_lines", start + 1, end - start)

    joined = joined.withColumn("_lines", F.split("text", "\n", -1))
    left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("_removed")), between)), "\n")
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(left)
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])

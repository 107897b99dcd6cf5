"""Mixing sources to target weights by systematic sampling.

A source's target is its share by weight of all words the mix takes, at most ``cap`` times its
size; what is above is shared again by weight (water filling). A document's expected copies are
its source's target over its source's size. These are summed up along the source, one random
offset per source is added, and a document is emitted once for every integer that its own step
crosses. Documents go by size, then by a hash of their id: neighbours are of like size, so what
one crossing takes too early another gives back, and a source's words differ from its target by
at most the words of its longest document.

All documents of a source step by the same amount, so the prefix sum is a rank times that step:
ranks come from counts per (source, size), per hash range within it, and from rows within a
range. No key is brought together, and steps are integers of 2**-24, so sums are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vecloom.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
#: Expected copies beyond whole ones are integers of this part.
UNIT_BITS = 24
HASH_DIGITS = 15
_KEY = ["_source", "_size"]
_CELL = [*_KEY, "_salt"]


def number_of(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def sized(docs: DataFrame, payload: bool = False) -> DataFrame:
    """Keys of every document: ``_source`` (never null), ``_size`` in words, ``_hash`` of the id; with ``payload`` the row itself."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    row = [F.struct(*(docs[c] for c in docs.columns)).alias("_row")] if payload else []
    return docs.select(F.col("doc_id").alias("_id"), source.alias("_source"), words.alias("_size"), number_of(own, HASH_DIGITS).alias("_hash"), *row)


def targets(sources: DataFrame, weights: Sequence[int] | Mapping[str | None, int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``_target`` to (``_source``, ``_words``), one row per source.

    A sequence of weights repeats over the sources by code point, null last; a mapping names
    them, and a source it leaves out weighs 0. In order of size over weight, a source is at
    its cap when its share of what is left by those before it is above. One row per source
    goes through one task, however many documents there are.
    """
    null_last = [F.col("_source") == "", F.col("_source")]
    if isinstance(weights, Mapping):
        named = [F.lit(x) for name, w in weights.items() for x in ("" if name is None else f"={name}", int(w))]
        weight = F.coalesce(F.element_at(F.create_map(*named), F.col("_source")), F.lit(0)) if named else F.lit(0)
    else:
        place = F.row_number().over(Window.orderBy(*null_last)) - 1
        weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    rows = sources.withColumn("_weight", weight.cast("bigint"))
    everything = Window.partitionBy(F.lit(0))
    order = Window.orderBy((F.col("_words") / F.nullif(F.col("_weight"), F.lit(0))).asc_nulls_last(), *null_last)
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "_all": F.lit(float(share)) * F.sum("_words").over(everything),
            "_limit": F.lit(float(cap)) * F.col("_words"),
            "_given": F.coalesce(F.lit(float(cap)) * F.sum("_words").over(before), F.lit(0.0)),
            "_open": F.sum("_weight").over(onward),
        }
    )
    rows = rows.withColumn("_full", F.col("_limit") * F.col("_open") < F.col("_weight") * (F.col("_all") - F.col("_given")))
    rows = rows.withColumns(
        {
            "_left": F.col("_all") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_limit"))).over(everything), F.lit(0.0)),
            "_open": F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything),
        }
    )
    shared = F.col("_weight") * F.col("_left") / F.nullif(F.col("_open"), F.lit(0))
    return rows.select("_source", "_words", F.when(F.col("_full"), F.col("_limit")).otherwise(F.coalesce(shared, F.lit(0.0))).alias("_target"))


def decide(
    docs: DataFrame,
    weights: Sequence[int] | Mapping[str | None, int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = "mix",
    payload: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken; with ``payload`` the whole row as ``row``.

    A null text has no words. Null ids, repeated rows and other columns do no harm: every row
    is a document of its own, and rows alike in source, size and id stand side by side in the
    order. An empty table gives no rows. Equal input and ``seed`` give equal copies.

    Ranks come from three counts: documents of smaller size in the source, of a smaller hash
    range in the same size, and smaller ones in the range. A range is the leading bits of the
    hash, about the square root of all rows of them, so neither a source nor a size that holds
    a third of all rows meets in one task. The first count is a sum along the distinct sizes
    of a source.
    """
    keys = cut_lineage(sized(docs))
    sizes = cut_lineage(keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    plan = targets(sizes.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_n")).alias("_words")), weights, share, cap)
    each = F.coalesce(F.col("_target") / F.nullif(F.col("_words"), F.lit(0)), F.lit(0.0))
    plan = plan.withColumns({"_whole": F.floor(each), "_part": F.floor((each - F.floor(each)) * F.lit(float(1 << UNIT_BITS)))})
    plan = plan.withColumn("_offset", number_of(F.concat(F.lit(f"{seed}/"), F.col("_source")), UNIT_BITS // 4))

    def before(*group: str) -> WindowSpec:
        return Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, -1)

    salt = F.shiftright("_hash", 4 * HASH_DIGITS - (total.bit_length() + 1) // 2)
    smaller = sizes.withColumn("_first", F.coalesce(F.sum("_n").over(before("_source").orderBy("_size")), F.lit(0))).drop("_n")
    cells = keys.groupBy(*_KEY, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumn("_base", F.coalesce(F.sum("_n").over(before(*_KEY).orderBy("_salt")), F.lit(0))).drop("_n")
    cells = cells.join(smaller.join(plan, "_source"), _KEY).withColumn("_base", F.col("_first") + F.col("_base")).drop("_first")

    rows = (sized(docs, True) if payload else keys).withColumn("_salt", salt)
    rows = rows.withColumn("_within", F.row_number().over(Window.partitionBy(*_CELL).orderBy("_hash", "_id"))).join(cells, _CELL)
    step = (F.col("_base") + F.col("_within")) * F.col("_part") + F.col("_offset")
    crossed = F.shiftright(step, UNIT_BITS) - F.shiftright(step - F.col("_part"), UNIT_BITS)
    rows = rows.withColumn("_copies", F.col("_whole") + crossed)
    names = {"_id": "doc_id", "_size": "size", "_words": "source_size", "_target": "target", "_copies": "copies"}
    shown = [F.col(c).alias(n) for c, n in names.items()]
    return rows.select(*shown, (F.col("_copies") * F.col("_size")).alias("taken"), *([F.col("_row").alias("row")] if payload else []))


def mix(
    docs: DataFrame,
    weights: Sequence[int] | Mapping[str | None, int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, all columns as they were. Texts are shuffled once."""
    rows = decide(docs, weights, share, cap, seed, payload=True).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*")

"""Mixing of sources to target weights by weighted fair queueing.

Every document of a source gets a place in a shuffled queue. A copy's virtual finish time is
the number of words its source has sent when the copy is through, divided by the source's
target. All copies are sorted by that time over all sources and cut off at the total budget.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import text_or_empty, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 20240229
#: Slices of a source's queue and of the virtual time. Each is sorted in one task, so the
#: largest source may hold about 10**10 documents before a slice gets 10**7 narrow rows.
SLICE_BITS = 10


#: Repeats of a document that one task lays out.
REPEATS = 1 << 16


def queue_place(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Place in the shuffled queue of the first row of a document; see ``repeat_place``."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def repeat_place(place: Column, number: Column) -> Column:
    """Place of the row of that number, from 0, among those equal in id and text."""
    return F.when(number == 0, place).otherwise(F.xxhash64(place, number))


def queue_of(groups: DataFrame) -> DataFrame:
    """One row per row of the table, from rows equal in all columns and their number ``n``.

    Each repeat has a place of its own, so a repeated document is taken as often as its source's
    cut says. Many repeats are laid out by many tasks.
    """
    last = lambda n, size: F.floor((n - 1) / F.lit(size)).cast("long")
    zero = F.lit(0).cast("long")
    blocks = groups.withColumn("block", F.explode(F.sequence(zero, last(F.col("n"), REPEATS))))
    blocks = blocks.repartition("place", "block")
    start = F.col("block") * REPEATS
    end = F.least(F.col("n"), start + REPEATS) - 1
    rows = blocks.withColumn("number", F.explode(F.sequence(start, end)))
    return rows.withColumn("place", repeat_place(F.col("place"), F.col("number"))).drop("n", "block", "number")


def numbered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with ``__place`` for each repeat; ``groups`` has source, place and n as ``queue_of`` needs.

    Only rows of repeated documents are stored and numbered, in two levels: by the part of the
    table where they lie, then by the parts before it.
    """
    repeated = groups.where("n > 1").select(F.col("source").alias("__source"), F.col("place").alias("__of"))
    if repeated.isEmpty():
        return rows
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("__place") == F.col("__of"))
    many = stored(rows.join(repeated, same, "left_semi").withColumn("__part", F.spark_partition_id()), "mix-repeats")
    keys = ["source", "__place"]
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = many.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    offsets = parts.select(
        F.col("source").alias("__source"), F.col("__place").alias("__of"), F.col("__part").alias("__in"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(F.lit(0)))
    many = many.withColumn("__number", inside - 1).join(offsets, same & (F.col("__part") == F.col("__in")))
    place = repeat_place(F.col("__place"), F.col("__number") + F.col("__offset"))
    return rows.join(repeated, same, "left_anti").unionByName(many.withColumn("__place", place).select(*rows.columns))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size -> also rank, weight, target and the budget, the sum of targets.

    Sources by code point, null last, take the weights in turn. They share ``share`` of all
    words by weight; none gets more than ``cap`` times its size, and what is over goes to the
    others by weight until none is above. One row per source, so the windows are small.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(ordered) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    # Sources fill up in the order of full_at; the level is what a unit of weight gets when
    # all before it are full.
    before = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    levelled = ranked.withColumn("level", level).withColumn(
        "at", F.max(F.when(F.col("full_at") > F.col("level"), F.col("level"))).over(everything)
    )
    target = F.when(F.col("at").isNull() | (F.col("full_at") <= F.col("at")), F.col("most")).otherwise(F.col("weight") * F.col("at"))
    return levelled.select("source", "source_size", "rank", "weight", target.alias("target")).withColumn(
        "budget", F.sum("target").over(everything)
    )


def source_cuts(
    queue: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, bits: int = SLICE_BITS
) -> DataFrame:
    """From source, size, place: one row per source with source_size, target and ``cuts``, the
    last place that the mix takes in each pass over the source (null: none).

    A hot source is cut into slices of places, whose sums are put in order; only narrow rows
    are shuffled, and never a source at once.
    """
    rows = queue.select(
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("key"),
        "size",
        "place",
        F.shiftright("place", 64 - bits).alias("slice"),
    )
    keys = ["key", "no_source"]
    slices = rows.groupBy(*keys, "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("offset", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    sizes = slices.groupBy(*keys).agg(F.sum("slice_size").alias("source_size"))
    targets = source_targets(sizes.withColumn("source", F.when(~F.col("no_source"), F.col("key"))), weights, share, cap).select(
        "source",
        "source_size",
        "rank",
        "target",
        "budget",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("key"),
    )
    heads = offsets.join(targets, keys).select(*keys, "slice", "offset", "source_size", "rank", "target", "budget")
    within = Window.partitionBy(*keys, "slice").orderBy("place")  # rows of one place count together
    sent = rows.where("size > 0").withColumn("sent", F.sum("size").over(within)).join(heads, [*keys, "slice"])
    passes = F.sequence(F.lit(0), F.lit(ceil(cap) - 1))
    copies = (
        sent.withColumn("pass", F.explode(passes))
        .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("offset") + F.col("sent")) / F.col("target"))
        .select("rank", "pass", "place", "size", "finish", "budget", F.floor(F.col("finish") * (1 << bits)).alias("span"))
    )
    spans = copies.groupBy("span").agg(F.sum("size").alias("span_size"))
    ordered = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("span", F.coalesce(F.sum("span_size").over(ordered), F.lit(0)).alias("start"))
    # Sizes are whole words and the sums of targets are not: allow for their rounding.
    taken = (
        copies.withColumn("run", F.sum("size").over(Window.partitionBy("span").orderBy("finish", "rank", "place")))
        .join(starts, "span")
        .where(F.col("start") + F.col("run") <= F.col("budget") + F.lit(1e-6))
        .groupBy("rank", "pass")
        .agg(F.max("place").alias("cut"))
    )
    cuts = taken.groupBy("rank").agg(F.collect_list("cut").alias("cuts"))
    return targets.join(cuts, "rank", "left").select(
        *keys, "source_size", "target", F.coalesce("cuts", F.expr("cast(array() as array<bigint>)")).alias("cuts")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    bits: int = SLICE_BITS,
    bare: bool = False,
) -> DataFrame:
    """All documents with size, source_size, target and copies (how often the mix has them).

    Needs doc_id, text, source; all other columns are kept unless ``bare``, which returns only
    doc_id and source with the new ones. Columns of the new names are replaced. Documents
    without words have size 0 and no copies, a null text counts as empty, null sources are one
    source, and an empty table gives none. Rows equal in id and text each have a place in the queue,
    so as many of them get a copy as the cut says. Reruns give the same mix.
    """
    new = ("size", "source_size", "target", "copies")
    kept = ["doc_id", "source"] if bare else [c for c in docs.columns if c not in new]
    place = queue_place(F.col("doc_id"), text_or_empty(F.col("text")), seed)
    sized = docs.select(
        *(["doc_id", "source"] if bare else kept), F.size(words_of(F.col("text"))).cast("long").alias("size"), place.alias("__place")
    )
    narrow = sized.select("doc_id", "source", "size", F.col("__place").alias("place")) if bare else sized.select("source", "size", F.col("__place").alias("place"))
    groups = stored(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n")), "mix-groups")
    queue = queue_of(groups)
    cuts = source_cuts(queue.select("source", "size", "place"), weights, share, cap, bits).withColumnsRenamed(
        {"key": "__key", "no_source": "__no_source", "cuts": "__cuts"}
    )
    rows = queue.withColumnRenamed("place", "__place") if bare else numbered(sized, groups)
    keyed = rows.withColumns({"__key": F.coalesce("source", F.lit("")), "__no_source": F.col("source").isNull()})
    taken = F.size(F.filter("__cuts", lambda cut: F.col("__place") <= cut))
    return keyed.join(cuts, ["__key", "__no_source"], "left").select(
        *kept, "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).alias("copies")
    )

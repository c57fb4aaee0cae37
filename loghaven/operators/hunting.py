"""Behavioural hunts: beacons, floods, event sequences, sliding counts, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghaven.functions.numeric import rounded
from loghaven.functions.once import evaluate_once


def arrival_gaps(events: DataFrame, key: Sequence[str], time: str, slice_seconds: int) -> DataFrame:
    """Microseconds between consecutive events of a key, one row per gap.

    A key is cut into time slices: ``lag`` runs within a slice, and the gap between
    slices comes from the slices' first and last times. A key with a large share of
    all events is thus many small windows, with the same gaps as one large window.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.select(*key, at.alias("_at")).filter(F.col("_at").isNotNull()).withColumn(
        "_slice", F.floor(F.col("_at") / F.lit(slice_seconds * 1_000_000))
    )
    within = rows.withColumn(
        "gap", F.col("_at") - F.lag("_at").over(Window.partitionBy(*key, "_slice").orderBy("_at"))
    ).select(*key, "gap")
    edges = rows.groupBy(*key, "_slice").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    between = edges.withColumn(
        "gap", F.col("_first") - F.lag("_last").over(Window.partitionBy(*key).orderBy("_slice"))
    ).select(*key, "gap")
    return within.unionByName(between).filter(F.col("gap").isNotNull())


def beacons(
    flows: DataFrame,
    time: str = "event_time",
    key: Sequence[str] = ("src_ip", "dest_ip", "dest_port"),
    min_events: int = 20,
    max_variation: float = 0.1,
    max_bytes: int | None = 1_000,
    slice_seconds: int = 60,
) -> DataFrame:
    """Keys whose events come at regular intervals with few bytes.

    Variation is the sample standard deviation of the gaps over their mean.
    """
    moments = gap_moments(flows, key, time, slice_seconds, None if max_bytes is None else "orig_bytes")
    return beacons_of(moments, key, min_events, max_variation, max_bytes)


def gap_moments(events: DataFrame, key: Sequence[str], time: str, slice_seconds: int = 60, size: str | None = None) -> DataFrame:
    """keys, events, first, last (microseconds), gaps, mean_gap, m2 (seconds), sized, size: one row per key.

    ``m2`` is the sum of squared deviations of the gaps. All comes from one scan, cut into time
    slices as in ``arrival_gaps``; events without a time count for ``sized`` and ``size`` alone.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    amount = F.lit(None).cast("double") if size is None else F.col(size).cast("double")
    rows = events.select(*key, at.alias("_at"), amount.alias("_size")).withColumn("_slice", F.floor(F.col("_at") / F.lit(slice_seconds * 1_000_000)))
    within = Window.partitionBy(*key, "_slice").orderBy("_at")
    gap = F.when(F.col("_at").isNotNull(), (F.col("_at") - F.lag("_at").over(within)) / 1e6)
    slices = rows.withColumn("_gap", gap).groupBy(*key, "_slice").agg(
        F.count("_at").alias("events"), F.min("_at").alias("first"), F.max("_at").alias("last"),
        F.count("_gap").alias("n"), F.avg("_gap").alias("mean"), F.var_pop("_gap").alias("var"),
        F.count("_size").alias("sized"), F.sum("_size").alias("size"),
    )
    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    between = (F.col("first") - F.max("last").over(earlier)) / 1e6
    parts = slices.withColumn("_parts", F.array(
        F.struct(F.col("n"), F.col("mean"), (F.col("var") * F.col("n")).alias("m2")),
        F.struct(F.when(between.isNotNull(), 1).otherwise(0).cast("long").alias("n"), between.alias("mean"), F.lit(0.0).alias("m2")),
    ))
    whole = Window.partitionBy(*key)
    own = F.aggregate("_parts", F.lit(0.0), lambda s, x: s + F.when(x["n"] > 0, x["n"] * x["mean"]).otherwise(0.0))
    count = F.aggregate("_parts", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    parts = parts.withColumn("_mean", F.try_divide(F.sum(own).over(whole), F.sum(count).over(whole)))
    deviation = F.aggregate(
        F.transform("_parts", lambda x: F.when(x["n"] > 0, x["m2"] + x["n"] * (x["mean"] - F.col("_mean")) * (x["mean"] - F.col("_mean"))).otherwise(0.0)),
        F.lit(0.0), lambda s, x: s + x,
    )
    return parts.groupBy(*key).agg(
        F.sum("events").alias("events"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum(count).alias("gaps"),
        F.max("_mean").alias("mean_gap"), F.sum(deviation).alias("m2"), F.sum("sized").alias("sized"), F.sum("size").alias("size"),
    )


def merge_moments(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """The moments of two spans of time, ``after`` the later one for each key, as of one pass over both."""
    names = ("events", "first", "last", "gaps", "mean_gap", "m2", "sized", "size")
    right = after.select(*[F.col(k).alias(f"_{k}") for k in key], *[F.col(n).alias(f"_{n}") for n in names])
    both = before.join(right, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]), "full")
    zero = lambda n: F.coalesce(F.col(n), F.lit(0))
    join = (F.col("_first") - F.col("last")) / 1e6
    parts = [(zero("gaps"), F.col("mean_gap"), zero("m2")), (zero("_gaps"), F.col("_mean_gap"), zero("_m2")), (F.when(join.isNotNull(), 1).otherwise(0), join, F.lit(0.0))]
    n = reduce(lambda a, b: a + b, [p[0] for p in parts])
    weighted = lambda f: reduce(lambda a, b: a + b, [F.when(p[0] > 0, f(p)).otherwise(0.0) for p in parts])
    both = both.withColumns({"_n": n.cast("long"), "_mean": F.try_divide(weighted(lambda p: p[0] * p[1]), n)})
    m2 = weighted(lambda p: p[2] + p[0] * (p[1] - F.col("_mean")) * (p[1] - F.col("_mean")))
    kept = [F.when(F.col("_events").isNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in key]
    return both.select(
        *kept, (zero("events") + zero("_events")).alias("events"), F.least("first", "_first").alias("first"), F.greatest("last", "_last").alias("last"),
        F.col("_n").alias("gaps"), F.col("_mean").alias("mean_gap"), m2.alias("m2"), (zero("sized") + zero("_sized")).alias("sized"),
        (zero("size") + zero("_size")).alias("size"),
    )


def beacons_of(
    moments: DataFrame, key: Sequence[str], min_events: int = 20, max_variation: float = 0.1, max_bytes: int | None = 1_000
) -> DataFrame:
    """Keys whose moments show regular gaps and few bytes."""
    std = F.sqrt(F.col("m2") / (F.col("gaps") - 1))
    regular = moments.where(F.col("gaps") > 1).withColumn("std_gap", std).where(
        (F.col("gaps") >= min_events - 1) & (F.col("mean_gap") > 0) & (F.col("std_gap") / F.col("mean_gap") < max_variation)
    )
    if max_bytes is not None:
        regular = regular.where(F.try_divide("size", "sized") <= max_bytes)
    return regular.select(
        *key,
        (F.col("gaps") + 1).alias("events"),
        rounded(F.col("mean_gap"), 3).alias("mean_gap_sec"),
        rounded(F.col("std_gap") / F.col("mean_gap"), 4).alias("variation"),
    )


def floods(
    flows: DataFrame, time: str, width: str = "1 minute", min_sources: int = 100
) -> DataFrame:
    """Destinations hit by more than ``min_sources`` distinct sources within one window."""
    per_source = flows.groupBy(
        F.window(F.col(time).cast("timestamp"), width).alias("w"), "dest_ip", "src_ip"
    ).agg(F.count("*").alias("n"))
    return (
        per_source.groupBy("w", "dest_ip")
        .agg(F.count("src_ip").alias("sources"), F.sum("n").alias("flows"))
        .filter(F.col("sources") > min_sources)
        .select(F.col("w.start").alias("window_start"), "dest_ip", "sources", "flows")
    )


def followed_by(
    events: DataFrame, entity: str, time: str, first: Column, then: Column, within_seconds: int,
    slice_seconds: int = 60,
) -> DataFrame:
    """For each ``first`` event, the nearest later ``then`` event of its entity within the span.

    An entity is cut into time slices. The nearest ``then`` event is looked for in the
    slice, in a frame that runs backwards in time and grows by one row at a time; if
    the slice has none, it is the earliest one of the next slice that does. An entity
    with a large share of all events is thus many small windows.
    """
    span = within_seconds * 1_000_000
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = (
        events.select(F.col(entity), at.alias("_at"), first.alias("_first"), then.alias("_then"))
        .filter(F.col("_at").isNotNull() & (F.col("_first") | F.col("_then")))
        .withColumn("_slice", F.floor(F.col("_at") / F.lit(slice_seconds * 1_000_000)))
    )
    then_at = F.when(F.col("_then"), F.col("_at"))
    backwards = Window.partitionBy(entity, "_slice").orderBy(F.col("_at").desc())
    in_slice = F.min(then_at).over(backwards.rangeBetween(Window.unboundedPreceding, -1))
    slices = rows.groupBy(entity, "_slice").agg(F.min(then_at).alias("_earliest"))
    later_slices = Window.partitionBy(entity).orderBy(F.col("_slice").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    after = slices.select(
        entity, "_slice", F.last("_earliest", ignorenulls=True).over(later_slices).alias("_after")
    ).filter(F.col("_after").isNotNull())
    return (
        rows.withColumn("_in", in_slice)
        .filter("_first")
        .join(after, [entity, "_slice"], "left")
        .withColumn("_next", F.coalesce("_in", "_after"))
        .filter(F.col("_next") - F.col("_at") <= span)
        .select(
            entity,
            F.timestamp_micros("_at").alias("first_at"),
            F.timestamp_micros("_next").alias("then_at"),
            rounded((F.col("_next") - F.col("_at")) / F.lit(1e6), 3).alias("gap_sec"),
        )
    )


def followed_by_stream(
    events: DataFrame, entity: str, time: str, first: Column, then: Column, within: str, watermark: str = "15 minutes"
) -> DataFrame:
    """``followed_by`` on a stream, in append mode: entity, first_at, then_at once a row is final.

    Two stateful operators: the events are joined with the later ones of their entity within the
    span, and the nearest is kept for each first event. Watermark and span bound the state of
    both. First events of an entity at one time are one row.
    """
    at = F.col(time).cast("timestamp")
    wanted = evaluate_once(
        events.withColumn("_at", at).withWatermark("_at", watermark),
        {"_first": F.coalesce(first, F.lit(False)), "_then": F.coalesce(then, F.lit(False))},
    )
    left = wanted.where("_first").select(F.col(entity), F.col("_at").alias("first_at"))
    right = wanted.where("_then").select(F.col(entity).alias("_entity"), F.col("_at").alias("then_at"))
    span = F.expr(f"INTERVAL {within}")
    near = (F.col(entity) == F.col("_entity")) & (F.col("then_at") > F.col("first_at")) & (F.col("then_at") <= F.col("first_at") + span)
    pairs = left.join(right, near, "inner")
    return pairs.groupBy(entity, "first_at").agg(F.min("then_at").alias("then_at"))


def tumbling_counts(
    events: DataFrame, time: str, keys: Sequence[str], width: str = "5 minutes", watermark: str | None = None
) -> DataFrame:
    """Events per window and key. Pass ``watermark`` on a stream to bound its state."""
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    if watermark is not None:
        rows = rows.withWatermark(time, watermark)
    return (
        rows.groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def sliding_counts(
    events: DataFrame, time: str, keys: Sequence[str], width: str = "5 minutes", slide: str = "1 minute"
) -> DataFrame:
    """Events per sliding window and key, from counts per slide.

    Each row is counted once in its slide; only the slide counts are repeated for
    the windows that hold them. ``width`` must be a multiple of ``slide``.
    """
    spans = events.sparkSession.range(1).select(
        *[F.timestamp_diff("MICROSECOND", F.lit(0).cast("timestamp"), F.lit(0).cast("timestamp") + F.expr(f"INTERVAL {x}")) for x in (width, slide)]
    ).first()
    if spans[0] % spans[1]:
        raise ValueError(f"a window of {width} is no multiple of its slide of {slide}")
    at = F.col(time).cast("timestamp")
    slots = events.groupBy(F.window(at, slide).alias("s"), *keys).agg(F.count("*").alias("c"))
    return (
        slots.select(F.col("s.start").alias("_at"), *keys, "c")
        .groupBy(F.window("_at", width, slide).alias("w"), *keys)
        .agg(F.sum("c").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def sliding_counts_stream(
    events: DataFrame, time: str, keys: Sequence[str], watermark: str,
    width: str = "5 minutes", slide: str = "1 minute", only: Column | None = None,
) -> DataFrame:
    """The same counts on a stream, with state bounded by the watermark.

    ``only`` picks the events that are counted; all events advance the watermark. A
    plain filter would be moved below the watermark, so the choice is made behind a
    generator.
    """
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    if only is not None:
        rows = evaluate_once(rows, {"_counted": F.coalesce(only, F.lit(False))}).filter("_counted")
    return (
        rows.groupBy(F.window(time, width, slide).alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def deduplicate(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the least by all columns, so the choice does not vary between runs."""
    rest = [c for c in events.columns if c not in key]
    if not rest:
        return events.select(*key).distinct()
    kept = events.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r"))
    return kept.select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*events.columns)


def deduplicate_stream(events: DataFrame, key: Sequence[str], time: str, watermark: str) -> DataFrame:
    """Drop repeats that arrive within the watermark of the first."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    return rows.dropDuplicatesWithinWatermark(list(key))

"""Address-range (CIDR) enrichment and the source -> destination flow map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghaven.functions.net import ipv4_number
from loghaven.operators.intel import fits_broadcast, hot_key_join, salted_join

MAX_BROADCAST_RANGES = 1_000_000
_ALL = 1 << 32
#: Bits below the prefix at each level.
LEVELS = (24, 16, 8, 0)
_RANGE_SIZE = "shiftleft(CAST(1 AS BIGINT), 32 - prefix_length)"


def parse_cidr(ranges: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Add prefix length, first and last address of a CIDR; rows that are none are dropped."""
    parts = F.split(cidr, "/")
    length = F.try_element_at(parts, F.lit(2)).try_cast("int")
    size = F.expr(_RANGE_SIZE)
    base = ranges.withColumns(
        {"_address": ipv4_number(F.try_element_at(parts, F.lit(1))), "prefix_length": length}
    ).filter(F.col("_address").isNotNull() & F.col("prefix_length").between(0, 32))
    return (
        base.withColumn("first_address", F.col("_address") - F.pmod(F.col("_address"), size))
        .withColumn("last_address", F.col("first_address") + size - 1)
        .drop("_address")
    )


def disjoint_ranges(ranges: DataFrame, label: str, cidr: str = "cidr") -> DataFrame:
    """Nested CIDRs -> disjoint address ranges, each with the label of the longest prefix.

    CIDRs nest or are apart, so between two neighbouring borders the longest prefix
    covering the lower border covers the whole stretch. It is found by equality on
    (prefix length, prefix), at most 33 keys per border; the table alone is read.
    """
    table = parse_cidr(ranges, cidr).groupBy("prefix_length", "first_address", "last_address").agg(
        F.min(label).alias(label)
    )
    borders = (
        table.select(F.explode(F.array("first_address", F.col("last_address") + 1)).alias("at"))
        .filter(F.col("at") < F.lit(_ALL))
        .distinct()
    )
    lengths = F.sequence(F.lit(0), F.lit(32))
    keyed = borders.select("at", F.explode(lengths).alias("prefix_length")).withColumn(
        "first_address",
        F.col("at")
        - F.pmod(F.col("at"), F.expr(_RANGE_SIZE)),
    )
    covering = (
        keyed.join(table, ["prefix_length", "first_address"])
        .groupBy("at")
        .agg(F.max_by(label, "prefix_length").alias(label))
    )
    # The next border is looked up per 2^24 block, then across blocks, so that no
    # window holds all borders.
    block = borders.withColumn("_b", F.floor(F.col("at") / F.lit(1 << 24)))
    in_block = block.withColumn("_next", F.lead("at").over(Window.partitionBy("_b").orderBy("at")))
    first_of_block = block.groupBy("_b").agg(F.min("at").alias("_first"))
    after = first_of_block.withColumn(
        "_after", F.lead("_first").over(Window.orderBy("_b"))  # at most 256 blocks
    ).select("_b", "_after")
    stretches = in_block.join(after, "_b").select(
        "at", (F.coalesce("_next", "_after", F.lit(_ALL)) - 1).alias("until")
    )
    return covering.join(stretches, "at").select(
        F.col("at").alias("first_address"), F.col("until").alias("last_address"), label
    )


def prefix_keys(ranges: DataFrame, label: str) -> DataFrame:
    """Disjoint ranges -> level, prefix, label: the aligned blocks of 2^24, 2^16, 2^8 and 1 addresses
    that they consist of.

    A range takes the largest blocks that fit, so each address lies in one block at most, and a
    CIDR becomes 128 blocks at most. The keys are equal to what an address is shifted by.
    """
    start, end = F.col("first_address"), F.col("last_address") + 1
    none = F.expr("cast(array() as array<bigint>)")
    keyed = lambda bits: lambda p: F.struct(F.lit(bits).alias("level"), p.alias("prefix"))
    cover_from, cover_to, parts = F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), []
    for bits in LEVELS:
        size = F.lit(1 << bits).cast("bigint")
        low, high = F.ceil(start / size).cast("bigint"), F.floor(end / size).cast("bigint")
        run = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
        around = F.concat(run(low, F.floor(cover_from / size).cast("bigint")), run(F.floor(cover_to / size).cast("bigint"), high))
        parts.append(F.transform(F.when(cover_from.isNull(), run(low, high)).otherwise(around), keyed(bits)))
        fits = low < high
        cover_from, cover_to = F.coalesce(F.when(fits, low * size), cover_from), F.coalesce(F.when(fits, high * size), cover_to)
    return ranges.select(label, F.explode(F.concat(*parts)).alias("_key")).select(
        F.col("_key.level").alias("_level"), F.col("_key.prefix").alias("_prefix"), label
    )


def locate(
    rows: DataFrame, ip: str, ranges: DataFrame, label: str, out: str,
    max_rows: int = MAX_BROADCAST_RANGES,
) -> DataFrame:
    """Add ``out``, the label of the range that holds the address, NULL when none does.

    ``ranges`` comes from ``disjoint_ranges``. They are looked up by prefix: an address has one key
    at each of four levels, and at most one of them is listed, so a lookup is four equality probes
    whether a block holds one range or 65,536. While the keys may be broadcast, every row is
    probed in its place by one table of them; beyond that bound the distinct addresses are looked
    up by a shuffle and joined back, with hot addresses spread.
    """
    keys = prefix_keys(ranges, label).withColumnRenamed(label, "_label")
    shifted = lambda n, bits: F.shiftright(n, bits).cast("bigint")
    if fits_broadcast(keys, max_rows):
        found = rows.withColumn("_n", ipv4_number(F.col(ip)))
        for bits in LEVELS:
            probe = F.broadcast(keys.select(F.col("_level").alias(f"_l{bits}"), F.col("_prefix").alias(f"_p{bits}"), F.col("_label").alias(f"_label{bits}")))
            here = (F.col(f"_l{bits}") == F.lit(bits)) & (F.col(f"_p{bits}") == shifted(F.col("_n"), bits))
            found = found.join(probe, here, "left")
        labels = F.coalesce(*[F.col(f"_label{bits}") for bits in LEVELS])
        return found.withColumn(out, labels).drop("_n", *[f"{x}{bits}" for bits in LEVELS for x in ("_l", "_p", "_label")])
    addresses = rows.select(ip).distinct().withColumn("_n", ipv4_number(F.col(ip))).filter(F.col("_n").isNotNull())
    probes = F.array(*[F.struct(F.lit(bits).alias("level"), shifted(F.col("_n"), bits).alias("prefix")) for bits in LEVELS])
    probed = addresses.select(ip, F.explode(probes).alias("_k")).select(ip, F.col("_k.level").alias("_level"), F.col("_k.prefix").alias("_prefix"))
    known = probed.join(keys, ["_level", "_prefix"]).select(ip, F.col("_label").alias(out))
    return (salted_join if rows.isStreaming else hot_key_join)(rows, known, ip, "left")


def flow_map(flows: DataFrame, ranges: DataFrame, label: str) -> DataFrame:
    """Flows, bytes and distinct sources per pair of source and destination area.

    Flows are first reduced to one row per address pair, so areas are looked up
    once per pair.
    """
    pairs = flows.groupBy("src_ip", "dest_ip").agg(
        F.count("*").alias("flows"), F.sum("orig_bytes").alias("bytes")
    )
    placed = locate(locate(pairs, "src_ip", ranges, label, "src_area"), "dest_ip", ranges, label, "dest_area")
    return placed.groupBy("src_area", "dest_area").agg(
        F.sum("flows").alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.count_distinct("src_ip").alias("sources"),
    )

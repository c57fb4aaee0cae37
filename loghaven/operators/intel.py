"""Threat-intelligence and asset joins of large logs with indicator tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of a table that every executor may hold a copy of; the bytes decide, and the rows
# only stop tables of very many tiny rows.
BROADCAST_ROWS = 8_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 16
#: Keys that a sketch may report and that it tracks.
HOT_KEYS, TRACKED_KEYS = 256, 16_384
#: Bits of a block of the prefilter (those of one ``bitmap_construct_agg``), bits for each listed key,
#: and hashes of a key.
BLOCK_BITS, KEY_BITS, KEY_HASHES = 32_768, 16, 4


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``small`` is within both bounds; bytes are those of the rows as text. One
    aggregate over the table, so no task gathers its rows."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in small.columns])))
    rows, text = small.agg(F.count("*"), F.sum(size)).first()
    return rows <= max_rows and (text or 0) <= max_bytes


def unique_by_key(table: DataFrame, key: str) -> DataFrame:
    """One row per key: the least of its rows by all other columns, so a join adds no rows."""
    rest = [c for c in table.columns if c != key]
    if not rest:
        return table.select(key).distinct()
    return (
        table.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("r"))
        .select(key, *[F.col(f"r.`{c}`").alias(c) for c in rest])
    )


def spread(rows: DataFrame, salts: int, column: str = "_salt") -> DataFrame:
    """Give rows an even salt. It is drawn by a fixed seed and the row's place in its task, so a
    task that is run again draws the same; equal rows spread too, and no column is read for it."""
    return rows.withColumn(column, F.floor(F.rand(17) * salts).cast("int"))


def replicate(rows: DataFrame, salts: int, column: str = "_salt") -> DataFrame:
    """One copy of every row per salt."""
    return rows.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffled join in which one key of ``big`` spreads over ``salts`` tasks.

    ``how`` is inner, left, left_semi or left_anti. Results are those of the plain join.
    """
    joined = spread(big, salts).join(replicate(small, salts), [key, "_salt"], how)
    return joined.drop("_salt")


def hot_keys(rows: DataFrame, key: str, parts: int | None = None) -> dict[object, int]:
    """Keys with more rows than a task's share, and over how many tasks each should go.

    A sketch of bounded size counts the keys in one pass over their column, combined map-side; a key
    above the share is in it, as the sketch's error is far below. At most ``HOT_KEYS`` come back.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})")
    n, found = rows.where(F.col(key).isNotNull()).agg(F.count("*"), top).first()
    share = max(1, n // parts)
    return {x["item"]: min(parts, -(-x["count"] // share)) for x in found or () if x["count"] > share}


def hot_key_join(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", parts: int | None = None, hot: dict[object, int] | None = None
) -> DataFrame:
    """Shuffled join that spreads the hot keys of ``big``, and only those, over several tasks.

    ``small`` is replicated for hot keys alone. The salt is a hash of the whole row, so a task that is
    run again deals its rows out as before, whatever order it reads them in. Rows without a key
    match nothing and are not shuffled at all. ``how`` is inner, left, left_semi or left_anti.
    """
    hot = hot_keys(big, key, parts) if hot is None else hot
    kind = big.schema[key].dataType
    table = F.create_map(*[x for k, n in hot.items() for x in (F.lit(k).cast(kind), F.lit(n))]) if hot else None
    salts = lambda: F.coalesce(F.try_element_at(table, F.col(key)), F.lit(1)) if hot else F.lit(1)
    keyed = big.where(F.col(key).isNotNull()).withColumn("_salt", F.pmod(F.xxhash64(*big.columns), salts()).cast("int"))
    copies = small.where(F.col(key).isNotNull()).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts() - 1)))
    joined = keyed.join(copies, [key, "_salt"], how).drop("_salt")
    if how not in ("left", "left_anti"):
        return joined
    return joined.unionByName(big.where(F.col(key).isNull()), allowMissingColumns=True)


def join_small(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Map-side join while ``small`` is within its bound; beyond it a shuffled join that spreads hot
    keys, which are counted first, or on a stream, which cannot be counted, all keys."""
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), key, how)
    return salted_join(big, small, key, how) if big.isStreaming else hot_key_join(big, small, key, how)


def listed_keys(indicators: DataFrame, key: str) -> DataFrame:
    """The key column without blanks: an empty indicator lists nothing."""
    return indicators.select(key).filter(F.col(key) != "")


def match_indicators(
    events: DataFrame, indicators: DataFrame, key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Events whose ``key`` is listed. Works on streams, with ``indicators`` static."""
    return join_small(events, listed_keys(indicators, key).distinct(), key, "left_semi", max_rows)


def tag_indicators(
    events: DataFrame, indicators: DataFrame, key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """All events, with the indicator's columns where their ``key`` is listed."""
    return join_small(events, unique_by_key(indicators, key), key, "left", max_rows)


def match_indicators_shuffled(events: DataFrame, indicators: DataFrame, key: str) -> DataFrame:
    """Events whose ``key`` is listed, as a sort-merge join.

    With ``spark.sql.optimizer.runtime.bloomFilter.enabled`` (on by default) Spark
    builds a Bloom filter of the indicators when the events are large, drops most
    events before they are shuffled, and lets the join settle the false positives.
    It does so for a filtered scan, which the exclusion of blanks provides.
    """
    return events.join(listed_keys(indicators, key).hint("merge"), key, "left_semi")


def _bits(key: str, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its places in it."""
    hashed = lambda seed: F.xxhash64(F.lit(seed), F.col(key))
    return F.pmod(hashed(0), F.lit(blocks)), [F.pmod(hashed(i + 1), F.lit(BLOCK_BITS)) for i in range(KEY_HASHES)]


def key_bitmaps(listed: DataFrame, key: str) -> tuple[DataFrame, int]:
    """_block, _bits: a Bloom filter of the keys in blocks of 4 KB, and the number of its blocks.

    A key's bits lie in one block, so one join on the block tests all of them. The filter has
    ``KEY_BITS`` bits a key, built by aggregates alone.
    """
    blocks = max(1, -(-listed.count() * KEY_BITS // BLOCK_BITS))
    block, places = _bits(key, blocks)
    each = listed.select(block.alias("_block"), F.explode(F.array(*places)).alias("_place"))
    return each.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits")), blocks


def passing(events: DataFrame, bitmaps: DataFrame, blocks: int, key: str) -> DataFrame:
    """Events whose key may be listed: all that are, and few others."""
    block, places = _bits(key, blocks)

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substr("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0

    rows = events.withColumn("_block", block).join(bitmaps, "_block")
    for place in places:
        rows = rows.where(is_set(place))
    return rows.drop("_block", "_bits")


def match_indicators_prefiltered(
    events: DataFrame, indicators: DataFrame, key: str, max_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Events whose ``key`` is listed, and the events that the filter let through to that join.

    The filter takes two bytes an indicator in place of its text, so it can be broadcast where the
    list cannot; beyond its own bound it is joined by a shuffle on the block. Only what passes
    is shuffled to the exact join.
    """
    listed = listed_keys(indicators, key).distinct()
    bitmaps, blocks = key_bitmaps(listed, key)
    small = blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES and blocks <= max_rows
    through = passing(events, F.broadcast(bitmaps) if small else bitmaps, blocks, key)
    return through.join(listed.hint("merge"), key, "left_semi"), through


def sightings(
    history: Sequence[tuple[str, DataFrame, str, str]], indicators: DataFrame,
    key: str = "indicator", max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Retroactive hunt: per indicator and source, first and last sighting and their number.

    ``history`` lists (source name, table, address column, time column). While the
    indicators fit, tables are filtered map-side and only hits are shuffled. Beyond
    that every table is first reduced to one row per address, map-side combined.
    """
    listed = indicators.select(key).distinct()
    small = fits_broadcast(listed, max_rows)
    parts = []
    for source, table, address, time in history:
        seen = table.select(F.col(address).alias(key), F.col(time).cast("timestamp").alias("at"))
        if small:
            seen = seen.join(F.broadcast(listed), key, "left_semi")
        summary = seen.groupBy(key).agg(
            F.min("at").alias("first_seen"),
            F.max("at").alias("last_seen"),
            F.count("*").alias("sightings"),
        )
        if not small:
            summary = summary.join(listed, key, "left_semi")
        parts.append(summary.select(key, F.lit(source).alias("source"), "first_seen", "last_seen", "sightings"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_bucketed(
    rows: DataFrame, table: str, key: str, buckets: int, salts: int = 1, replicated: bool = False,
    path: str | None = None,
) -> None:
    """Save as a table bucketed and sorted by key and salt, for joins without a shuffle.

    The big side spreads each key over ``salts`` buckets and the small side holds
    one copy per salt, so a key with a large share of the rows is no single task.
    """
    salted = replicate(rows, salts) if replicated else spread(rows, salts)
    writer = (
        salted.repartition(buckets, F.col(key), F.col("_salt"))
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key, "_salt")
        .sortBy(key, "_salt")
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)


def join_bucketed(big: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join two tables from ``write_bucketed``; neither side is exchanged."""
    return big.join(small.hint("merge"), [key, "_salt"], how).drop("_salt")


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, within: str
) -> DataFrame:
    """Pairs with equal key and ``right_time`` in [left_time, left_time + within].

    The same expression serves batch and, with a watermark on both sides, streams. Tables are
    also joined on time buckets as wide as the interval, a right row in its own bucket and the
    one before, so a key with many rows meets those of its neighbouring buckets only.
    """
    span = F.expr(f"INTERVAL {within}")
    other = right.withColumnRenamed(key, f"_{key}")
    condition: Column = (
        (F.col(key) == F.col(f"_{key}"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + span)
    )
    if left.isStreaming or right.isStreaming:
        return left.join(other, condition, "inner").drop(f"_{key}")
    zero = F.lit(0).cast("timestamp")
    width = F.greatest(F.timestamp_diff("MICROSECOND", zero, zero + span), F.lit(1))
    bucket = lambda time: F.floor(F.unix_micros(F.col(time).cast("timestamp")) / width)
    left = left.withColumn("_bucket", bucket(left_time))
    other = other.withColumn("_at", bucket(right_time)).withColumn("_other", F.explode(F.array("_at", F.col("_at") - 1))).drop("_at")
    return left.join(other, condition & (F.col("_bucket") == F.col("_other")), "inner").drop(f"_{key}", "_bucket", "_other")

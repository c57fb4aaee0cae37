"""Windowed rules on a stream, stream-stream correlation, and their settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.operators.intel import interval_join
from loghaven.operators.rules import (
    DEFAULT_RULES, HIT_COLUMNS, Rule, apply_thresholds, describe_hits, rule_candidates,
)


def use_durable_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB and checkpoint its changes only."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def watermark_policy(spark: SparkSession, policy: str) -> None:
    """``min`` waits for the slowest stream, ``max`` drops state by the fastest."""
    if policy not in ("min", "max"):
        raise ValueError(f"unknown watermark policy {policy}")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)


def windowed_hits_stream(
    logs: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    width: str = "5 minutes",
    watermark: str = "15 minutes",
    time: str = "ingest_ts",
) -> DataFrame:
    """The windowed rules on a stream, in append mode: a window's hits appear once it is final.

    Two chained window aggregations: per distinct item, then per value, as in batch.
    State is one row per open window, rule, value and item.
    """
    rows = logs.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    candidates = rule_candidates(rows, rules, carry=[F.col(time)], prefilter=False)
    per_item = candidates.groupBy(F.window(time, width).alias("w"), "rule_no", "matched_value", "item").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    per_value = per_item.groupBy(F.window("w", width).alias("window"), "rule_no", "matched_value").agg(
        F.sum("n").alias("n"), F.count("item").alias("items"), F.sum("amount").alias("amount")
    )
    return describe_hits(apply_thresholds(per_value, rules), rules).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *HIT_COLUMNS
    )


def correlate_streams(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: str, left_watermark: str = "15 minutes", right_watermark: str = "15 minutes",
) -> DataFrame:
    """Pairs of events of two streams with equal key, the right one at most ``within`` later.

    Both watermarks and the interval let Spark drop rows that can no longer pair.
    """
    left = left.withColumn(left_time, F.col(left_time).cast("timestamp")).withWatermark(left_time, left_watermark)
    right = right.withColumn(right_time, F.col(right_time).cast("timestamp")).withWatermark(
        right_time, right_watermark
    )
    return interval_join(left, right, key, left_time, right_time, within)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """key, value, partition_id: what a stateful operator of a stream remembers, read from its
    checkpoint after the last batch, or after ``batch_id``. The stream need not run."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """window_start, window_end, keys, n of the counts that a windowed stream has not given out yet."""
    state = state_rows(spark, checkpoint, operator)
    keys = [f.name for f in state.schema["key"].dataType][1:]
    window = state.schema["key"].dataType[0].name
    return state.select(
        F.col(f"key.`{window}`.start").alias("window_start"), F.col(f"key.`{window}`.end").alias("window_end"),
        *[F.col(f"key.`{k}`").alias(k) for k in keys], F.col("value.count").alias("n"),
    )

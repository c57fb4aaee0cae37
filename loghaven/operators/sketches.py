"""Distinct counts from stored sketches, merged for any period without a second scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.lake import BATCH, write_batch

#: Base-2 logarithm of a sketch's registers; the error of an estimate is about 1.04 / sqrt(2^LG), and
#: with 12 three times that is under 5 %.
LG = 12
ERROR = 3 * 1.04 / 2 ** (LG / 2)


def daily_sketches(rows: DataFrame, time: str, keys: Sequence[str], value: str, lg: int = LG) -> DataFrame:
    """day, keys, sketch, n: one sketch of the distinct values per day and key, and its rows.

    A sketch has a few KB at most and is built map-side, so a key with a third of all rows
    reaches its reducer as one sketch for each task.
    """
    day = F.to_date(F.col(time).cast("timestamp")).alias("day")
    counted = rows.where(F.col(value).isNotNull()).groupBy(day, *keys)
    return counted.agg(F.hll_sketch_agg(value, lg).alias("sketch"), F.count("*").alias("n"))


def merged(sketches: DataFrame, keys: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """keys, sketch, n over the days from ``start`` to ``end``, both included; fewer keys than those
    stored, also none, merge over the rest."""
    if start is not None:
        sketches = sketches.where(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        sketches = sketches.where(F.col("day") <= F.to_date(F.lit(end)))
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n").alias("n"))


def estimated(sketches: DataFrame, keys: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """keys, distinct (an estimate, see ERROR), n over a period."""
    found = merged(sketches, keys, start, end)
    return found.select(*keys, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("distinct"), F.coalesce("n", F.lit(0)).alias("n"))


class SketchTable:
    """Sketches of each batch below ``path``, by batch. A batch is read once, when it comes, and
    writing it again replaces its sketches; questions read sketches alone."""

    def __init__(self, path: str, time: str, keys: Sequence[str], value: str, lg: int = LG):
        self.path, self.time, self.keys, self.value, self.lg = path, time, tuple(keys), value, lg

    def add(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(daily_sketches(batch, self.time, self.keys, self.value, self.lg), self.path, None, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BATCH)

    def estimate(self, spark: SparkSession, keys: Sequence[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
        return estimated(self.read(spark), self.keys if keys is None else keys, start, end)


def port_scanners(sketches: DataFrame, key: str, start: str, end: str, min_ports: int) -> DataFrame:
    """Sources whose sketches of destination ports, merged over some days, hold more than that many."""
    return estimated(sketches, [key], start, end).where(F.col("distinct") > min_ports)

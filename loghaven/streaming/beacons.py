"""Beacon statistics kept up batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.lake import folders
from loghaven.operators.hunting import beacons_of, gap_moments, merge_moments


class BeaconState:
    """Moments of the gaps of each key, merged with those of every batch; no batch is read again.

    The state after a batch is a table of its own below ``path``, made of the newest one of an
    earlier batch, so a replayed batch counts once and a restarted job goes on. Events that are
    not later than the last one seen of their key in earlier batches would change gaps that are
    already merged; they are left out and counted in ``late``.
    """

    def __init__(self, path: str, key: Sequence[str] = ("src_ip", "dest_ip", "dest_port"), time: str = "event_time", size: str | None = "orig_bytes"):
        self.path, self.key, self.time, self.size = path, tuple(key), time, size

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch_{batch_id:019d}"

    def state(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest state, or the newest before a batch."""
        done = sorted(f.rsplit("/", 2)[-2] for f in folders(spark, f"{self.path}/batch_*/_SUCCESS"))
        done = [d for d in done if before is None or int(d.rsplit("_", 1)[1]) < before]
        return spark.read.parquet(f"{self.path}/{done[-1]}") if done else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        old = self.state(batch.sparkSession, batch_id)
        rows = batch.select(*self.key, F.col(self.time).cast("timestamp").alias("_time"), *([self.size] if self.size else []))
        if old is None:
            new = gap_moments(rows, self.key, "_time", size=self.size).withColumn("late", F.lit(0).cast("long"))
        else:
            seen = old.select(*[F.col(k).alias(f"_{k}") for k in self.key], F.col("last").alias("_last"))
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key])
            known = rows.join(seen, same, "left").drop(*[f"_{k}" for k in self.key]).persist()
            try:
                is_late = F.coalesce(F.unix_micros("_time") <= F.col("_last"), F.lit(False))
                fresh = gap_moments(known.where(~is_late), self.key, "_time", size=self.size)
                late = known.where(is_late).groupBy(*[F.col(k).alias(f"_{k}") for k in self.key]).agg(F.count("*").alias("_late"))
                merged = merge_moments(old.drop("late"), fresh, self.key)
                both = merged.join(old.select(*[F.col(k).alias(f"_{k}") for k in self.key], "late"), same, "left").drop(*[f"_{k}" for k in self.key])
                new = both.join(late, same, "left").withColumn("late", F.coalesce("late", F.lit(0)) + F.coalesce("_late", F.lit(0)))
                new = new.drop("_late", *[f"_{k}" for k in self.key])
                new.write.mode("overwrite").parquet(self._at(batch_id))
            finally:
                known.unpersist()
            return
        new.write.mode("overwrite").parquet(self._at(batch_id))

    def beacons(self, spark: SparkSession, min_events: int = 20, max_variation: float = 0.1, max_bytes: int | None = 1_000) -> DataFrame:
        state = self.state(spark)
        if state is None:
            raise AnalysisException(f"no batch was processed below {self.path}")
        return beacons_of(state, self.key, min_events, max_variation, max_bytes)

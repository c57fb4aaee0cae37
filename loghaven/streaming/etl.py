"""The log stream job: parse, enrich, land, evaluate rules, land alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loghaven.lake import Lake
from loghaven.operators.logs import log_base, parse_logs
from loghaven.operators.rules import DEFAULT_RULES, Rule, SqlRule, evaluate_rules


def parsed_stream(records: DataFrame, strict: bool = False) -> DataFrame:
    """topic, timestamp, value -> parsed logs with ``batch_ts``.

    ``batch_ts`` is the batch time of the offset log: a replayed batch sees the same
    value, so everything derived from it lands in the same partitions.
    """
    return parse_logs(log_base(records), strict).withColumn("batch_ts", F.current_timestamp())


def land_batch(
    batch: DataFrame, batch_id: int, lake: Lake, rules: Sequence[Rule | SqlRule] = DEFAULT_RULES
) -> None:
    """Write one batch of parsed logs and its alerts. Errors propagate and stop the query,
    so a batch that failed is not committed but replayed, and overwrites what it left."""
    batch = batch.persist()
    try:
        first = batch.select("batch_ts").first()
        if first is None:
            return
        lake.write_batch(batch, "logs_parsed", batch_id)
        alerts = evaluate_rules(batch, rules, F.lit(first["batch_ts"]))
        lake.write_batch(alerts, "alerts", batch_id)
    finally:
        batch.unpersist()


def start_log_etl(
    records: DataFrame,
    lake: Lake,
    checkpoint: str,
    rules: Sequence[Rule | SqlRule] = DEFAULT_RULES,
    strict: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job. ``trigger`` defaults to as fast as possible."""
    writer = (
        parsed_stream(records, strict)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, lake, rules))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_archive(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """A second reader of the same log at its own pace: raw records by topic."""
    writer = (
        log_base(records)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy("source_topic")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()

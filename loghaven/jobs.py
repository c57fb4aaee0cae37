"""The jobs as programs for spark-submit: ``python -m loghaven.jobs <job> ...``."""

from __future__ import annotations

import argparse
import datetime
import json
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from loghaven.lake import Lake, use_utc
from loghaven.operators import anomaly, maintenance
from loghaven.operators.rules import select_rules
from loghaven.sources import files, streams
from loghaven.sources.merge import write_merged
from loghaven.streaming import etl, windows
from loghaven.streaming.detector import DecayingDetector, FlowDetector
from loghaven.streaming.models import ModelStore


def kafka_settings(env: Mapping[str, str], topics: tuple[str, ...]) -> dict:
    limit = env.get("MAX_OFFSETS_PER_TRIGGER")
    return {
        "bootstrap_servers": env.get("KAFKA_BOOTSTRAP_SERVERS", "kafka-broker:9092"),
        "topics": topics,
        "starting_offsets": env.get("KAFKA_STARTING_OFFSETS", "earliest"),
        "max_offsets_per_trigger": int(limit) if limit else None,
    }


def detector_settings(env: Mapping[str, str]) -> dict:
    return {
        "k": int(env.get("KMEANS_K", anomaly.CLUSTERS)),
        "threshold": float(env.get("ANOMALY_THRESHOLD", anomaly.THRESHOLD)),
    }


def log_rules(env: Mapping[str, str]) -> tuple:
    """The default rules, or those of RULES (comma-separated ids), with the thresholds of
    RULE_THRESHOLDS (JSON: rule id to number)."""
    ids = [r for r in env.get("RULES", "").split(",") if r]
    return select_rules(*ids, thresholds=json.loads(env.get("RULE_THRESHOLDS", "{}")))


def log_etl(spark: SparkSession, lake: Lake, checkpoint: str, env: Mapping[str, str]) -> None:
    """Parse log topics into logs_parsed and alerts until stopped."""
    lake.create_tables(spark)
    records = streams.read_kafka(spark, **kafka_settings(env, streams.LOG_TOPICS))
    etl.start_log_etl(records, lake, checkpoint, log_rules(env), env.get("STRICT_PARSING") == "1").awaitTermination()


def flow_detector(spark: SparkSession, lake: Lake, checkpoint: str, env: Mapping[str, str]) -> None:
    """Score the flow topic into network_flows, network_anomalies and model_metrics until stopped."""
    lake.create_tables(spark)
    topic = env.get("KAFKA_TOPIC", streams.FLOW_TOPIC)
    records = streams.read_kafka(spark, **kafka_settings(env, (topic,)))
    FlowDetector(lake, **detector_settings(env)).start(records, checkpoint).awaitTermination()


def moving_detector(spark: SparkSession, lake: Lake, checkpoint: str, env: Mapping[str, str]) -> None:
    """As the flow detector, but with centers that move with every batch, from the newest model that
    the flow detector has trained. CENTERS_DECAY per batch, or CENTERS_HALF_LIFE in rows."""
    lake.create_tables(spark)
    baseline = ModelStore(spark, f"{lake.location}/models").latest()
    if baseline is None:
        raise RuntimeError("no model yet: run flow-detector until its cold start is over")
    half_life = env.get("CENTERS_HALF_LIFE")
    detector = DecayingDetector(
        lake, baseline, float(env.get("CENTERS_DECAY", 1.0)), float(half_life) if half_life else None, detector_settings(env)["threshold"]
    )
    topic = env.get("KAFKA_TOPIC", streams.FLOW_TOPIC)
    records = streams.read_kafka(spark, **kafka_settings(env, (topic,)))
    detector.start(records, checkpoint).awaitTermination()


def archive(spark: SparkSession, lake: Lake, checkpoint: str, env: Mapping[str, str]) -> None:
    """Copy the raw records of the log topics below the lake until stopped."""
    records = streams.read_kafka(spark, **kafka_settings(env, streams.LOG_TOPICS))
    etl.start_archive(records, f"{lake.location}/archive", checkpoint).awaitTermination()


def windowed_rules(spark: SparkSession, lake: Lake, checkpoint: str, env: Mapping[str, str]) -> None:
    """Evaluate the rules over event-time windows of the log topics until stopped."""
    windows.use_durable_state(spark)
    logs = etl.parsed_stream(streams.read_kafka(spark, **kafka_settings(env, streams.LOG_TOPICS)))
    hits = windows.windowed_hits_stream(logs, log_rules(env))
    hits.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", f"{lake.location}/windowed_hits").start().awaitTermination()


def upkeep(spark: SparkSession, lake: Lake, table: str, keep_days: int | None, fold: str | None, closed_batch: int, today: str) -> None:
    """Retention and compaction of a lake table: drop dates older than ``keep_days``, fold one date."""
    if keep_days is not None:
        for date in maintenance.expire_lake(spark, lake, {table: keep_days}, today)[table]:
            print(f"dropped\t{table}\t{date}")
    if fold is not None:
        files = maintenance.fold_batches(spark, lake, table, fold, closed_batch, f"{lake.location}/_staging/{uuid.uuid4().hex}")
        print(f"folded\t{table}\t{fold}\t{files}")


def merge_logs(spark: SparkSession, source: str, target: str) -> None:
    """Merge equal-named .log files below ``source`` into ``target`` and print the line counts.

    The target may hold other files, but must not lie in the source."""
    if os.path.join(target, "").startswith(os.path.join(source, "")):
        raise ValueError(f"the target {target} lies in the source {source}")
    lines = files.read_lines(spark, source, ".log")
    write_merged(lines, target)
    report = files.inventory(lines, files.list_files(spark, source, ".log"))
    for row in report.orderBy("file_name").toLocalIterator():
        print(f"{row.file_name or 'all logs'}\t{row.line_count}\t{row.source_count}")


STREAM_JOBS = {
    "log-etl": log_etl,
    "flow-detector": flow_detector,
    "moving-detector": moving_detector,
    "archive": archive,
    "windowed-rules": windowed_rules,
}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="loghaven.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in STREAM_JOBS:
        job = jobs.add_parser(name)
        job.add_argument("--lake", required=True, help="folder of the lake tables")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--database", default="siem")
    keep = jobs.add_parser("upkeep")
    keep.add_argument("--lake", required=True)
    keep.add_argument("--database", default="siem")
    keep.add_argument("--table", required=True)
    keep.add_argument("--keep-days", type=int)
    keep.add_argument("--fold", help="date whose closed batches become one")
    keep.add_argument("--closed-batch", type=int, default=-1, help="last batch that is never replayed")
    keep.add_argument("--today", default=datetime.date.today().isoformat())
    merge = jobs.add_parser("merge-logs")
    merge.add_argument("--src", default="raw_data")
    merge.add_argument("--dest", default="data")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"loghaven-{args.job}").getOrCreate()
    use_utc(spark)
    if args.job == "merge-logs":
        merge_logs(spark, args.src, args.dest)
        return
    lake = Lake(args.database, args.lake.rstrip("/"))
    if args.job == "upkeep":
        upkeep(spark, lake, args.table, args.keep_days, args.fold, args.closed_batch, args.today)
        return
    STREAM_JOBS[args.job](spark, lake, args.checkpoint, os.environ)


if __name__ == "__main__":
    main()

"""Lake tables and log files that Spark derives from the given tables, once per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from checks.sql import DETECTED_AT
from loghaven.lake import folders, new_folder, use_utc, write_in_place, write_partitioned
from loghaven.operators.flows import only_anomalies, to_network_flows
from loghaven.operators.logs import parse_logs, to_logs_parsed
from loghaven.operators.rules import evaluate_rules

# Batches in which the record files of logs and of flows are read, and rows of one file.
LOG_BATCHES, FLOW_BATCHES, FILE_ROWS = 4, 3, 500_000
# Flows looked at to find where a batch ends.
BOUND_SAMPLE = 10_000

_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Folder with what ``write(folder)`` left there, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        use_utc(spark)
        folder = new_folder(spark, name)
        write(folder)
        _written[key] = folder
    return _written[key]


def detected_at():
    return F.to_timestamp(F.lit(DETECTED_AT))


def logs_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        write_partitioned(to_logs_parsed(parse_logs(views.raw_logs(spark, sf_dir))), folder, "ingest_date")

    return spark.read.parquet(written(spark, sf_dir, "logs_parsed", write))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        rows = evaluate_rules(logs_parsed(spark, sf_dir), detected_at=detected_at())
        write_partitioned(rows, folder, "detect_date")

    return spark.read.parquet(written(spark, sf_dir, "alerts", write))


def network_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        write_in_place(to_network_flows(views.scored_flows(spark, sf_dir)), folder, "ingest_date")

    return spark.read.parquet(written(spark, sf_dir, "network_flows", write))


def network_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        write_in_place(only_anomalies(network_flows(spark, sf_dir)), folder, "ingest_date")

    return spark.read.parquet(written(spark, sf_dir, "network_anomalies", write))


def record_parts(rows: DataFrame, batches: int) -> int:
    """Files a batch needs, so that none holds more than about ``FILE_ROWS`` of the rows."""
    return max(1, -(-rows.count() // (batches * FILE_ROWS)))


def files_per_batch(spark: SparkSession, folder: str, batches: int) -> int:
    """Files a stream takes at once, to read a folder of record files in so many batches."""
    return -(-len(folders(spark, f"{folder}/*.parquet")) // batches)


def log_record_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw logs as Parquet files of topic, timestamp, value, in time order."""

    def write(folder: str) -> None:
        rows = views.log_records(views.raw_logs(spark, sf_dir))
        parts = LOG_BATCHES * record_parts(views.table(spark, sf_dir, "events"), LOG_BATCHES)
        rows.repartitionByRange(parts, "timestamp", "value").write.parquet(folder)

    return written(spark, sf_dir, "log_records", write)


def flow_json(flows: DataFrame) -> DataFrame:
    """Flows under connection-record names, as JSON text."""
    return flows.select(
        "kafka_ts",
        F.to_json(
            F.struct(
                F.col("ts").cast("bigint").alias("ts"),
                "uid",
                F.col("src_ip").alias("id.orig_h"),
                F.col("src_port").alias("id.orig_p"),
                F.col("dest_ip").alias("id.resp_h"),
                F.col("dest_port").alias("id.resp_p"),
                "proto",
                "service",
                "duration",
                "orig_bytes",
                "resp_bytes",
                "conn_state",
            )
        ).alias("raw_log"),
    )


def batch_bounds(flows: DataFrame, batches: int) -> list:
    """Conditions that cut flows into so many runs of about equal size by arrival and id, from a sample of them."""
    key = F.struct(F.unix_micros("kafka_ts").alias("at"), F.col("uid"))
    share = min(1.0, BOUND_SAMPLE / max(1, flows.count()))
    sample = flows.select(key.alias("key")).sample(share, seed=42).orderBy("key").collect()
    cuts = [sample[len(sample) * n // batches]["key"] for n in range(1, batches)] if sample else []
    below = [key < F.struct(F.lit(c["at"]).cast("bigint").alias("at"), F.lit(c["uid"]).cast("string").alias("uid")) for c in cuts]
    return [~low & high for low, high in zip([F.lit(False), *below], [*below, F.lit(True)])]


def flow_record_files(spark: SparkSession, sf_dir: str) -> str:
    """Flow records as Parquet files of topic, timestamp, value, batch after batch in time order; each batch is written
    where its rows are read, as a shuffle of all texts would take more disk than the files."""

    def write(folder: str) -> None:
        flows = views.flows(spark, sf_dir)
        parts = record_parts(views.table(spark, sf_dir, "lineitem"), FLOW_BATCHES)
        for mine in batch_bounds(flows, FLOW_BATCHES):
            rows = flow_json(flows.where(mine)).select(
                F.lit("real_network_logs").alias("topic"),
                F.col("kafka_ts").alias("timestamp"),
                F.col("raw_log").cast("binary").alias("value"),
            )
            rows.coalesce(parts).write.mode("append").option("compression", "zstd").parquet(folder)

    return written(spark, sf_dir, "flow_records", write)

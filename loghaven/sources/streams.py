"""Log streams with the columns topic, timestamp, value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.schemas import LOG_RECORD

# The topics.
LOG_TOPICS = (
    "web-logs", "syslogs", "app-logs", "win-event-logs", "real_network_logs",
    "dns-logs", "ssl-logs", "ssh-logs",
)
FLOW_TOPIC = "real_network_logs"


def kafka_options(
    bootstrap_servers: str,
    topics: tuple[str, ...] = LOG_TOPICS,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. Topics are given as a pattern, so one that is absent is no error.

    ``max_offsets_per_trigger`` bounds the records of a micro-batch, hence its memory.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribePattern": "|".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """Kafka stream; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(**options))
        .load()
        .select("topic", "timestamp", "value")
    )


def read_record_files(
    spark: SparkSession,
    path: str,
    topics: tuple[str, ...] = LOG_TOPICS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same stream from Parquet files of log records dropped into a folder."""
    reader = spark.readStream.schema(LOG_RECORD)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).filter(F.col("topic").isin(*topics))


def read_table_stream(
    spark: SparkSession, folder: str, file_name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Any Parquet file set of a folder as a stream, in the files' own schema."""
    schema = spark.read.parquet(f"{folder}/{file_name}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)

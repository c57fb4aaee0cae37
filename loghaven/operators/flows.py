"""Connection records: parsing, validity and the scored-flow projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions.once import evaluate_once
from loghaven.schemas import FLOW_JSON, NETWORK_FLOWS, TYPED_FLOW_JSON


def epoch_or_iso(ts: Column) -> Column:
    """Event time from epoch seconds or ISO text; NULL when it is neither."""
    return F.coalesce(F.timestamp_seconds(ts.try_cast("double")), F.try_to_timestamp(ts))


def parse_flows(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """kafka_ts, raw_log (JSON text) -> typed flow columns. Failed casts are NULL."""
    j = F.col("j")
    parsed = evaluate_once(
        records.select("kafka_ts", "raw_log", *keep), {"j": F.from_json("raw_log", FLOW_JSON)}
    )
    return parsed.select(
        "kafka_ts",
        *keep,
        j.getField("ts").try_cast("double").alias("ts"),
        epoch_or_iso(j.getField("ts")).alias("event_time"),
        j.getField("uid").alias("uid"),
        j.getField("id.orig_h").alias("src_ip"),
        j.getField("id.orig_p").try_cast("int").alias("src_port"),
        j.getField("id.resp_h").alias("dest_ip"),
        j.getField("id.resp_p").try_cast("int").alias("dest_port"),
        j.getField("proto").alias("proto"),
        j.getField("service").alias("service"),
        j.getField("duration").try_cast("double").alias("duration"),
        j.getField("orig_bytes").try_cast("bigint").alias("orig_bytes"),
        j.getField("resp_bytes").try_cast("bigint").alias("resp_bytes"),
        j.getField("conn_state").alias("conn_state"),
        j.getField("is_attack").alias("is_attack"),
    )


def valid_flows(flows: DataFrame) -> DataFrame:
    """Rows with a source, a destination and a destination port."""
    return flows.dropna(subset=["src_ip", "dest_ip", "dest_port"]).filter(
        ~F.col("src_ip").isin("", "-")
    )


def parse_flows_typed(records: DataFrame) -> DataFrame:
    """The notebook reading: numbers typed in the JSON schema, rows without features dropped."""
    j = F.col("j")
    return (
        evaluate_once(records.select("raw_log"), {"j": F.from_json("raw_log", TYPED_FLOW_JSON)})
        .select(
            j.getField("duration").alias("duration"),
            j.getField("orig_bytes").alias("orig_bytes"),
            j.getField("resp_bytes").alias("resp_bytes"),
            j.getField("id.orig_h").alias("src_ip"),
            j.getField("id.resp_h").alias("dest_ip"),
            j.getField("id.resp_p").alias("dest_port"),
            j.getField("proto").alias("proto"),
            j.getField("conn_state").alias("conn_state"),
        )
        .dropna(subset=["dest_port", "duration", "orig_bytes", "resp_bytes"])
    )


def to_network_flows(scored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project scored flows to the network_flows table, and the columns in ``keep``.

    The date comes from the record's arrival time, not from the clock, so that a
    batch replayed after midnight lands in the partition it first went to.
    """
    return scored.withColumns(
        {
            "ingest_ts": F.col("kafka_ts"),
            "ingest_date": F.to_date("kafka_ts"),
        }
    ).select(*NETWORK_FLOWS.fieldNames(), *keep)


def only_anomalies(scored: DataFrame) -> DataFrame:
    return scored.filter("is_anomaly")

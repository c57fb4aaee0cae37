"""Schemas of the lake tables and of the JSON records that feed them."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Column names and types of the five lake tables.
LOGS_PARSED = T.StructType(
    _strings(
        "raw_log", "source_topic", "client_ip", "http_method", "request_path", "status_code",
        "bytes_sent", "syslog_host", "syslog_program", "app_event", "app_service",
        "country", "city", "intelligence_tag", "dest_port",
    )
    + [
        T.StructField("orig_bytes", T.LongType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

ALERTS = T.StructType(
    _strings("rule_id", "rule_name", "severity", "description", "matched_field", "matched_value")
    + [T.StructField("hit_count", T.LongType())]
    + _strings("country", "city")
    + [T.StructField("detected_at", T.TimestampType()), T.StructField("detect_date", T.DateType())]
)

NETWORK_FLOWS = T.StructType(
    [
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("uid", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dest_ip", T.StringType()),
        T.StructField("dest_port", T.IntegerType()),
        T.StructField("proto", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("orig_bytes", T.LongType()),
        T.StructField("resp_bytes", T.LongType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("is_dst_external", T.IntegerType()),
        T.StructField("is_src_server", T.IntegerType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("anomaly_score", T.FloatType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

MODEL_METRICS = T.StructType(
    [
        T.StructField("training_id", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("wssse", T.DoubleType()),
        T.StructField("training_duration_sec", T.DoubleType()),
        T.StructField("training_rows", T.LongType()),
    ]
)

# name -> (schema, partition column or None)
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "logs_parsed": (LOGS_PARSED, "ingest_date"),
    "alerts": (ALERTS, "detect_date"),
    "network_flows": (NETWORK_FLOWS, "ingest_date"),
    "network_anomalies": (NETWORK_FLOWS, "ingest_date"),
    "model_metrics": (MODEL_METRICS, None),
}

# JSON keys of application logs and of sensor records found in log topics.
LOG_JSON = T.StructType(
    _strings(
        "host", "user-identifier", "authuser", "datetime", "request", "status", "bytes",
        "referer", "agent",
        "id.orig_h", "id.resp_h", "id.resp_p", "dest_port", "orig_bytes", "proto", "service",
        "method", "uri", "status_code", "response_body_len", "query",
    )
)

# Keys of a connection record. Numbers are read as text and cast later.
FLOW_JSON = T.StructType(
    _strings(
        "ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "service",
        "duration", "orig_bytes", "resp_bytes", "conn_state", "orig_pkts", "resp_pkts",
    )
    + [T.StructField("is_attack", T.BooleanType())]
)

# The notebook reading of a connection record types its numbers in the schema.
TYPED_FLOW_JSON = T.StructType(
    [
        T.StructField("id.resp_p", T.IntegerType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("orig_bytes", T.LongType()),
        T.StructField("resp_bytes", T.LongType()),
    ]
    + _strings("id.orig_h", "id.resp_h", "proto", "conn_state")
)

EVE_JSON = T.StructType(
    _strings("event_type", "timestamp", "flow_id", "src_ip")
    + [T.StructField("src_port", T.LongType())]
    + _strings("dest_ip")
    + [T.StructField("dest_port", T.LongType())]
    + _strings("proto", "app_proto")
    + [
        T.StructField(
            "flow",
            T.StructType(
                [
                    T.StructField("age", T.DoubleType()),
                    T.StructField("bytes_toserver", T.LongType()),
                    T.StructField("bytes_toclient", T.LongType()),
                    T.StructField("pkts_toserver", T.LongType()),
                    T.StructField("pkts_toclient", T.LongType()),
                ]
            ),
        ),
        T.StructField("alert", T.StructType(_strings("signature"))),
    ]
)

# Shape of every log stream, whatever carries it.
LOG_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
    ]
)

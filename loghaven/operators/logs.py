"""Raw log records -> typed, enriched log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions import geo, text
from loghaven.functions.once import evaluate_once
from loghaven.schemas import LOG_JSON, LOGS_PARSED

WINDOWS_TOPIC = "win-event-logs"


def log_base(records: DataFrame) -> DataFrame:
    """Carrier columns (topic, timestamp, value) -> source_topic, kafka_ts, raw_log."""
    return records.select(
        F.col("topic").alias("source_topic"),
        F.col("timestamp").alias("kafka_ts"),
        F.col("value").cast("string").alias("raw_log"),
    )


def with_json(logs: DataFrame) -> DataFrame:
    """Bind the parsed JSON object once as ``j``; its fields are NULL on malformed text.

    Only text that opens an object is parsed: a parse that fails costs far more than
    the test, and most lines of a mixed log are not JSON.
    """
    opens_object = F.col("raw_log").rlike(r"^\s*\{")
    return evaluate_once(logs, {"j": F.when(opens_object, F.from_json("raw_log", LOG_JSON))})


class _Json:
    """Fields of ``j`` and the two ways of asking whether a record carries one.

    Parity mode asks the raw text, as the dashboards in use expect: a URL that
    contains ``orig_bytes`` counts as carrying it. Strict mode asks the parsed
    object.
    """

    def __init__(self, strict: bool):
        self.strict = strict

    def field(self, name: str) -> Column:
        return F.col("j").getField(name)

    def carries(self, name: str, marker: str) -> Column:
        if self.strict:
            return self.field(name).isNotNull()
        return F.col("raw_log").contains(marker)


def log_fields(logs: DataFrame, strict: bool = False) -> DataFrame:
    """Extract the per-format fields; ``logs`` needs source_topic, raw_log and ``j``.

    In parity mode a sensor record without its own status code reports its
    destination port as ``status_code``, and the hour of a syslog line stands for its
    program; strict mode leaves the first ``''`` and reads the second after the host.
    """
    json = _Json(strict)
    line = F.col("raw_log")
    program = text.SYSLOG_PROGRAM_AFTER_HOST if strict else text.SYSLOG_PROGRAM
    source = text.WINDOWS_SOURCE_AFTER_HOST if strict else text.WINDOWS_SOURCE

    address = F.when(
        json.carries("id.orig_h", "id.orig_h"), json.field("id.orig_h")
    ).otherwise(text.group1(line, text.FIRST_TOKEN))

    method = F.when(json.carries("method", '"method"'), json.field("method")).otherwise(
        text.group1(line, text.REQUEST_METHOD)
    )

    path = (
        F.when(json.carries("uri", '"uri"'), json.field("uri"))
        .when(json.carries("query", '"query"'), json.field("query"))
        .otherwise(text.group1(line, text.REQUEST_PATH))
    )

    has_port = json.carries("id.resp_p", "id.resp_p")
    status = F.when(json.carries("status_code", '"status_code"'), json.field("status_code"))
    if not strict:
        status = status.when(has_port, json.field("id.resp_p"))
    status = status.otherwise(text.group1(line, text.RESPONSE_STATUS))

    sent = (
        F.when(
            json.carries("response_body_len", '"response_body_len"'),
            json.field("response_body_len"),
        )
        .when(json.carries("bytes", '"bytes"'), json.field("bytes"))
        .otherwise(text.group1(line, text.RESPONSE_BYTES))
    )

    port = F.when(has_port, json.field("id.resp_p")).when(
        json.carries("dest_port", "dest_port"), json.field("dest_port")
    )

    out_bytes = F.when(
        json.carries("orig_bytes", "orig_bytes"), json.field("orig_bytes").try_cast("bigint")
    )

    event = F.when(
        F.col("source_topic") == WINDOWS_TOPIC, text.group1(line, source)
    ).otherwise(json.field("status"))

    return logs.select(
        *[c for c in logs.columns if c != "j"],
        address.alias("client_ip"),
        method.alias("http_method"),
        path.alias("request_path"),
        status.alias("status_code"),
        sent.alias("bytes_sent"),
        text.group1(line, text.SYSLOG_HOST).alias("syslog_host"),
        text.group1(line, program).alias("syslog_program"),
        event.alias("app_event"),
        json.field("request").alias("app_service"),
        port.alias("dest_port"),
        out_bytes.alias("orig_bytes"),
    )


def enrich_address(logs: DataFrame, ip: str = "client_ip") -> DataFrame:
    """Add country, city and intelligence_tag of the address in ``ip``."""
    return logs.withColumns(
        {
            "country": geo.country_of(F.col(ip)),
            "intelligence_tag": geo.intelligence_tag(F.col(ip)),
        }
    ).withColumn("city", geo.city_of(F.col("country")))


def with_ingest_time(logs: DataFrame, now: Column | None = None) -> DataFrame:
    """ingest_ts = kafka_ts, else ``now``; ingest_date and detect_date follow from it.

    ``now`` defaults to the current time, which in a streaming plan is the batch
    time kept in the checkpoint, hence the same when a batch is replayed.
    """
    now = F.current_timestamp() if now is None else now
    return logs.withColumn(
        "ingest_ts", F.coalesce(F.col("kafka_ts").cast("timestamp"), now)
    ).withColumns(
        {"ingest_date": F.to_date("ingest_ts"), "detect_date": F.to_date("ingest_ts")}
    )


def parse_logs(logs: DataFrame, strict: bool = False, now: Column | None = None) -> DataFrame:
    """source_topic, kafka_ts, raw_log -> all parsed columns. Other columns are kept."""
    return with_ingest_time(enrich_address(log_fields(with_json(logs), strict)), now)


def to_logs_parsed(parsed: DataFrame) -> DataFrame:
    """Project to the columns of the logs_parsed table."""
    return parsed.select(*LOGS_PARSED.fieldNames())


def drop_noise(lines: DataFrame, patterns: list[str], column: str = "raw_log") -> DataFrame:
    """Remove known-noise lines. Rows with NULL text are kept."""
    noisy = F.coalesce(F.col(column).rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))
    return lines.filter(~noisy)


def noise_counts(lines: DataFrame, patterns: list[str], column: str = "raw_log") -> DataFrame:
    """How many lines each pattern removes; a line counts under its first match."""
    which = None
    for p in patterns:
        hit = F.col(column).rlike(p)
        which = F.when(hit, p) if which is None else which.when(hit, p)
    return (
        lines.select(which.alias("pattern"))
        .filter(F.col("pattern").isNotNull())
        .groupBy("pattern")
        .agg(F.count("*").alias("removed_lines"))
    )


"""The given tables in the shape of security logs and flows (FIXTURES.md section 3).

Projections only, so each view is as large as its table and also works on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.lake import use_utc
from loghaven.operators.features import FEATURES, flow_features, scale_features
from loghaven.operators.anomaly import score_scaled

# Start and length of the month over which flows are taken to have arrived.
MONTH_START = 1704067200
MONTH_SECONDS = 2592000

# The eight fixed centers: id = 4 i + 2 j + m.
CENTERS = [
    [ab, ab, 0.3, d, e]
    for ab in (0.5, -1.0)
    for d in (-1.73, 0.58)
    for e in (-0.33, 3.0)
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_logs_of(events: DataFrame) -> DataFrame:
    """event_id, source_topic, kafka_ts, raw_log from event rows, batch or stream."""
    k, b = F.col("k"), F.col("b")
    user = F.col("user_id")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    base = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("b"),
    )
    digit = k % 10
    topic = (
        F.when(F.col("event_type") == "view", "web-logs")
        .when(F.col("event_type") == "error", "syslogs")
        .when(F.col("event_type") == "purchase", "app-logs")
        .when(F.col("event_type") == "signup", "win-event-logs")
        .when(digit == 9, "dns-logs")
        .when(digit == 8, "ssl-logs")
        .when(digit == 7, "ssh-logs")
        .otherwise("real_network_logs")
    )
    ip = (
        F.when(user % 8 < 5, F.lit("17.5.5.100"))
        .when(user % 8 == 5, text("10.0.0.", user))
        .when(user % 8 == 6, F.lit("95.1.1.200"))
        .otherwise(text("41.2.3.", user))
    )
    verb = F.element_at(F.array(*[F.lit(v) for v in ("GET", "POST", "PUT", "DELETE")]), k % 4 + 1)
    path = (
        F.when(k % 20 == 3, F.lit("/a/../../etc/passwd"))
        .when(k % 20 == 7, F.lit("/q?x=UNION+SELECT"))
        .otherwise(text("/p/", k % 10))
    )
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("200", "401", "403", "404", "500", "503", "301", "200")]), k % 8 + 1
    )
    size = F.when(k % 13 == 0, F.lit("-")).otherwise(b.cast("string"))
    web = text(F.col("ip"), ' - - [01/Jan/2024:00:00:00 +0000] "', verb, " ", path, ' HTTP/1.1" ', status, " ", size)
    syslog = F.when(
        k % 2 == 0, text("Jan  5 01:02:03 host", user % 5, " sshd[", k, "]: Failed password for root")
    ).otherwise(text("Jan  5 01:02:03 host", user % 5, " cron[", k, "]: session opened"))
    windows = text("Jan  5 01:02:03 WINHOST Security[", k, "]: logon")
    event = F.element_at(F.array(*[F.lit(s) for s in ("error", "critical", "ok")]), k % 3 + 1)
    app = text('{"host":"', F.col("ip"), '","request":"svc-', k % 6, '","status":"', event, '","bytes":', b, "}")
    dns = text(
        '{"id.orig_h":"', F.col("ip"),
        '","id.resp_h":"8.8.8.8","id.resp_p":53,"proto":"udp","query":"h', k, '.example.com"}',
    )
    flow = text(
        '{"uid":"C', F.col("event_id"), '","id.orig_h":"', F.col("ip"), '","id.resp_h":"52.0.0.', k,
        '","id.resp_p":', k + 20, ',"proto":"tcp","service":"http","duration":"0.5","orig_bytes":', b * 10, "}",
    )
    source = F.col("source_topic")
    raw = (
        F.when(source == "web-logs", web)
        .when(source == "syslogs", syslog)
        .when(source == "win-event-logs", windows)
        .when(source == "app-logs", app)
        .when(source == "dns-logs", dns)
        .otherwise(flow)
    )
    return (
        base.withColumns({"source_topic": topic, "ip": ip})
        .select("event_id", "source_topic", F.col("ts").alias("kafka_ts"), raw.alias("raw_log"))
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs_of(table(spark, sf_dir, "events"))


def log_records(logs: DataFrame) -> DataFrame:
    """Raw logs in the shape of a log stream: topic, timestamp, value."""
    return logs.select(
        F.col("source_topic").alias("topic"),
        F.col("kafka_ts").alias("timestamp"),
        F.col("raw_log").cast("binary").alias("value"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flows from line items; kafka_ts spreads them over one month."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    arrival = MONTH_START + (F.col("l_orderkey") * 7919 + line * 104729) % MONTH_SECONDS
    src = (
        F.when(supp % 10 == 0, "192.168.1.250")
        .when(supp % 10 < 5, F.concat(F.lit("10.0.0."), (supp % 250).cast("string")))
        .otherwise(F.concat(F.lit("41.7.0."), (supp % 250).cast("string")))
    )
    dest = F.concat(
        F.when(part % 4 == 0, "172.16.0.").otherwise("52.1.0."), (part % 250).cast("string")
    )
    proto = F.when(F.col("l_returnflag") == "A", "tcp").when(F.col("l_returnflag") == "N", "udp").otherwise("icmp")
    state = (
        F.when(line == 2, "S0").when(line == 3, "REJ").when(line == 4, "RSTO")
        .when(line == 5, "RSTOS0").when(line == 6, "OTH").otherwise("SF")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("C"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string")).alias("uid"),
        F.timestamp_seconds(arrival).alias("kafka_ts"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("ts"),
        src.alias("src_ip"),
        (49152 + F.col("l_orderkey") % 16000).cast("int").alias("src_port"),
        dest.alias("dest_ip"),
        (1 + part % 1024).cast("int").alias("dest_port"),
        proto.alias("proto"),
        F.when(line == 7, F.lit(None)).when(line % 2 == 0, "http").otherwise("dns").alias("service"),
        (F.col("l_quantity") / 10).alias("duration"),
        F.floor(F.col("l_extendedprice") * 100).cast("bigint").alias("orig_bytes"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").alias("resp_bytes"),
        state.alias("conn_state"),
    )


def scored_flows(spark: SparkSession, sf_dir: str, threshold: float = 3.0) -> DataFrame:
    """Flows scaled over the whole table and scored against the fixed centers."""
    scaled = scale_features(flow_features(flows(spark, sf_dir)))
    points = [F.col(f"z_{f}") for f in FEATURES]
    return score_scaled(scaled, points, CENTERS, threshold)


def labelled_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored flows with an attack label; the uid prefix names the kind."""
    kind = (
        F.when(F.col("orig_bytes") >= 9_000_000, "EXFIL")
        .when((F.col("conn_state") == "REJ") & (F.col("duration") < 1), "SCAN")
        .when((F.col("conn_state") == "S0") & (F.col("is_dst_external") == 0), "DDOS")
    )
    return (
        scored_flows(spark, sf_dir)
        .withColumn("kind", kind)
        .withColumn("is_attack", F.col("kind").isNotNull())
        .withColumn("uid", F.concat(F.coalesce(F.concat("kind", F.lit("_")), F.lit("")), F.col("uid")))
        .drop("kind")
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt as listed addresses."""
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") < 0)
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("41.7.0."), (F.col("s_suppkey") % 250).cast("string")).alias("indicator"),
            F.col("n_name").alias("origin"),
        )
    )


def address_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested CIDRs: a /29 per nation inside a /8 and a /16 per region."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    narrow = nations.select(
        F.concat(F.lit("41.7.0."), (F.col("n_nationkey") * 8).cast("string"), F.lit("/29")).alias("cidr"),
        F.col("n_name").alias("area"),
    )
    wide = regions.select(
        F.concat((F.lit(40) + F.col("r_regionkey")).cast("string"), F.lit(".0.0.0/8")).alias("cidr"),
        F.col("r_name").alias("area"),
    )
    middle = regions.select(
        F.concat(F.lit("52."), F.col("r_regionkey").cast("string"), F.lit(".0.0/16")).alias("cidr"),
        F.concat(F.col("r_name"), F.lit("-CLOUD")).alias("area"),
    )
    return narrow.unionByName(wide).unionByName(middle)

"""Dashboard and cookbook queries over parsed logs, alerts, anomalies and model metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions.numeric import rounded
from loghaven.plans.forensics import since, since_date, with_share

# Status codes and message patterns the charts ask for.
CLIENT_ERRORS = ("400", "401", "403", "404", "429")
LOGIN_FAILURES = ("%Failed password%", "%authentication failure%")
AUTH_FAILURES = LOGIN_FAILURES + ("%Invalid user%",)


def _topic(logs: DataFrame, name: str) -> DataFrame:
    return logs.filter(F.col("source_topic") == name)


def _any_like(patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.col("raw_log").like(p)
    return out


def _ranked(rows: DataFrame, keys: list[str], n: str, limit: int | None = None) -> DataFrame:
    """Count per key, most frequent first, ties by key."""
    out = rows.groupBy(*keys).agg(F.count("*").alias(n)).orderBy(F.desc(n), *keys)
    return out if limit is None else out.limit(limit)


# -- logs ---------------------------------------------------------------------


def events_per_topic(logs: DataFrame) -> DataFrame:
    return _ranked(logs, ["source_topic"], "event_count")


def top_error_sources(logs: DataFrame, limit: int = 10) -> DataFrame:
    return _ranked(logs.filter(F.col("status_code").isin("404", "403")), ["client_ip"], "error_count", limit)


def heavy_posters(logs: DataFrame, min_posts: int = 100) -> DataFrame:
    posts = _ranked(logs.filter(F.col("http_method") == "POST"), ["client_ip"], "post_count")
    return posts.filter(F.col("post_count") > min_posts)


def failed_logins(logs: DataFrame) -> DataFrame:
    return _ranked(logs.filter(_any_like(LOGIN_FAILURES)), ["syslog_host"], "failure_count")


def program_activity(logs: DataFrame) -> DataFrame:
    """Rows per program; a line without one counts under ``''``, which is not NULL."""
    return _ranked(logs.filter(F.col("syslog_program").isNotNull()), ["syslog_program"], "activity_count")


def service_errors(logs: DataFrame) -> DataFrame:
    return _ranked(
        logs.filter(F.col("app_event").isin("error", "critical")), ["app_service", "app_event"], "event_count"
    )


def hourly_trend(logs: DataFrame) -> DataFrame:
    return (
        logs.groupBy(F.window("ingest_ts", "1 hour").alias("w"))
        .agg(F.count("*").alias("event_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")
        .orderBy("window_start")
    )


def daily_volume(logs: DataFrame) -> DataFrame:
    return (
        logs.groupBy("ingest_date").agg(F.count("*").alias("daily_total")).orderBy(F.desc("ingest_date"))
    )


def latest_logs(logs: DataFrame, limit: int = 20) -> DataFrame:
    return logs.orderBy(F.desc("ingest_ts"), "raw_log").limit(limit)


def top_client_errors(logs: DataFrame, limit: int = 25) -> DataFrame:
    rows = _topic(logs, "web-logs").filter(F.col("status_code").isin(*CLIENT_ERRORS))
    return _ranked(rows, ["client_ip"], "error_count", limit)


def method_share(logs: DataFrame) -> DataFrame:
    counts = _topic(logs, "web-logs").groupBy("http_method").agg(F.count("*").alias("request_count"))
    return with_share(counts, "request_count").orderBy(F.desc("request_count"), "http_method")


def post_brute_force(logs: DataFrame, today: Column, days: int = 1, min_posts: int = 200) -> DataFrame:
    posts = since_date(_topic(logs, "web-logs"), today, days).filter(F.col("http_method") == "POST")
    return _ranked(posts, ["client_ip"], "post_count").filter(F.col("post_count") > min_posts)


def top_paths(logs: DataFrame, limit: int = 20) -> DataFrame:
    return _ranked(_topic(logs, "web-logs"), ["request_path"], "hit_count", limit)


def auth_failures(logs: DataFrame) -> DataFrame:
    return _ranked(_topic(logs, "syslogs").filter(_any_like(AUTH_FAILURES)), ["syslog_host"], "failure_count")


def top_programs(logs: DataFrame, limit: int = 15) -> DataFrame:
    named = F.col("syslog_program").isNotNull() & (F.col("syslog_program") != "")
    return _ranked(_topic(logs, "syslogs").filter(named), ["syslog_program"], "activity_count", limit)


def app_status(logs: DataFrame) -> DataFrame:
    rows = _topic(logs, "app-logs").filter(F.col("app_event").isNotNull())
    return _ranked(rows.withColumnRenamed("app_event", "status_code_app"), ["status_code_app"], "count").select(
        F.col("status_code_app").alias("status_code"), "count"
    )


def top_endpoints(logs: DataFrame, limit: int = 20) -> DataFrame:
    rows = _topic(logs, "app-logs").filter(F.col("app_service").isNotNull())
    return _ranked(rows.withColumnRenamed("app_service", "endpoint"), ["endpoint"], "hit_count", limit)


def hourly_by_topic(logs: DataFrame, today: Column, days: int = 1) -> DataFrame:
    return (
        since_date(logs, today, days)
        .groupBy(F.date_format("ingest_ts", "yyyy-MM-dd HH:00").alias("hour_bucket"), "source_topic")
        .agg(F.count("*").alias("event_count"))
        .orderBy("hour_bucket", "source_topic")
    )


def daily_trend(logs: DataFrame, today: Column, days: int = 7) -> DataFrame:
    return daily_volume(since_date(logs, today, days))


def unauthorized_by_ip(logs: DataFrame) -> DataFrame:
    return _ranked(logs.filter(F.col("status_code") == "401"), ["client_ip"], "count")


def recent_event_count(logs: DataFrame, as_of: Column, period: str = "5 MINUTES") -> DataFrame:
    return since(logs, as_of, period).agg(F.count("*").alias("event_count"))


def missing_paths_of(logs: DataFrame, client_ip: str) -> DataFrame:
    return logs.filter((F.col("client_ip") == client_ip) & (F.col("status_code") == "404")).select("request_path")


def log_volume(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count("*").alias("count"))


def events_per_second(logs: DataFrame) -> DataFrame:
    return _per_grain(logs, "ingest_ts", "second")


def hourly_vs_last_week(logs: DataFrame, days: int = 7) -> DataFrame:
    """Events per hour beside those of the same hour ``days`` earlier, NULL where it had none."""
    hours = logs.groupBy(F.date_trunc("hour", F.col("ingest_ts")).alias("hour")).agg(
        F.count("*").alias("event_count")
    )
    earlier = hours.select(
        (F.col("hour") + F.expr(f"INTERVAL {days * 24} HOURS")).alias("hour"),
        F.col("event_count").alias("earlier_count"),
    )
    return hours.join(earlier, "hour", "left").orderBy("hour")


# -- alerts -------------------------------------------------------------------


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("count"))


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return _ranked(alerts, ["severity"], "count")


def alert_feed(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    rows = alerts.select(
        "detected_at", "rule_name", "severity", "matched_field", "matched_value", "hit_count", "country"
    ).orderBy(F.desc("detected_at"), "rule_name", "matched_value")
    return rows if limit is None else rows.limit(limit)


# -- anomalies ----------------------------------------------------------------


def anomaly_count(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(F.count("*").alias("count"))


def average_score(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(rounded(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"))


def _per_grain(rows: DataFrame, time: str, grain: str) -> DataFrame:
    return (
        rows.groupBy(F.date_trunc(grain, F.col(time)).alias("bucket"))
        .agg(F.count("*").alias("count"))
        .orderBy("bucket")
    )


def anomaly_timeline(anomalies: DataFrame) -> DataFrame:
    return _per_grain(anomalies, "ingest_ts", "minute")


def anomalies_by_service(anomalies: DataFrame) -> DataFrame:
    return _ranked(anomalies, ["service"], "count")


def anomalies_by_source(anomalies: DataFrame, limit: int | None = None) -> DataFrame:
    return _ranked(anomalies, ["src_ip"], "count", limit)


def anomaly_feed(anomalies: DataFrame, limit: int | None = None) -> DataFrame:
    rows = anomalies.select(
        "ingest_ts", "src_ip", "src_port", "dest_ip", "dest_port", "proto", "service", "anomaly_score"
    ).orderBy(F.desc("ingest_ts"), "src_ip", "src_port", "dest_ip", "dest_port", "anomaly_score")
    return rows if limit is None else rows.limit(limit)


# -- model --------------------------------------------------------------------


def model_stability(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy(F.date_trunc("day", F.col("ingest_ts")).alias("day"))
        .agg(F.avg("wssse").alias("avg_wssse"))
        .orderBy("day")
    )

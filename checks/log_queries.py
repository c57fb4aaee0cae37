"""Parsing, enrichment, rules and log dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import prepared, views
from checks.registry import register
from checks.sql import AS_OF, RULES, TODAY, rnd, rule_select, with_tables
from loghaven.functions.jsonx import json_contains
from loghaven.operators import logs as L
from loghaven.operators import rules as R
from loghaven.plans import dashboards as D
from loghaven.plans import forensics as X


def as_of():
    return F.to_timestamp(F.lit(AS_OF))


def today():
    return F.to_date(F.lit(TODAY))


# -- parsing ------------------------------------------------------------------


def parsed(spark, sf_dir):
    return L.parse_logs(views.raw_logs(spark, sf_dir))


def _fields(*names):
    return lambda spark, sf_dir: parsed(spark, sf_dir).select("event_id", *names)


def _parsed_sql(*names):
    return with_tables("parsed", select=f"SELECT event_id, {', '.join(names)} FROM parsed")


register(
    "p01_log_base",
    lambda s, d: L.log_base(views.log_records(views.raw_logs(s, d))),
    with_tables("raw_logs", select="SELECT source_topic, kafka_ts, raw_log FROM raw_logs"),
)
for _name, _cols in {
    "p02_access_log_fields": ("client_ip", "http_method", "request_path", "status_code", "bytes_sent"),
    "p03_syslog_fields": ("syslog_host", "syslog_program"),
    "p05_app_log_fields": ("app_event", "app_service"),
    "p08_dest_port": ("source_topic", "dest_port"),
    "p09_orig_bytes": ("source_topic", "orig_bytes"),
    "p10_country": ("client_ip", "country"),
    "p11_city": ("country", "city"),
    "p12_intelligence_tag": ("client_ip", "intelligence_tag"),
    "p13_ingest_time": ("ingest_ts", "ingest_date"),
}.items():
    register(_name, _fields(*_cols), _parsed_sql(*_cols))

register(
    "p04_json_fields",
    lambda s, d: L.with_json(views.raw_logs(s, d)).select(
        "event_id",
        F.col("j").getField("host").alias("host"),
        F.col("j").getField("request").alias("request"),
        F.col("j").getField("status").alias("status"),
        F.col("j").getField("id.resp_p").alias("resp_p"),
        F.col("j").getField("query").alias("query"),
    ),
    with_tables(
        "raw_logs",
        select="""SELECT event_id, json_extract_string(js, '$.host') AS host,
  json_extract_string(js, '$.request') AS request, json_extract_string(js, '$.status') AS status,
  json_extract_string(js, '$."id.resp_p"') AS resp_p, json_extract_string(js, '$.query') AS query
FROM (SELECT event_id, CASE WHEN json_valid(raw_log) THEN raw_log END AS js FROM raw_logs)""",
    ),
)
register(
    "p06_windows_event_source",
    lambda s, d: parsed(s, d).filter(F.col("source_topic") == L.WINDOWS_TOPIC).select("event_id", "app_event"),
    with_tables(
        "parsed", select="SELECT event_id, app_event FROM parsed WHERE source_topic = 'win-event-logs'"
    ),
)
register(
    "p07_sensor_fields",
    lambda s, d: parsed(s, d)
    .filter(F.col("raw_log").contains("id.orig_h"))
    .select("event_id", "client_ip", "http_method", "request_path", "status_code", "bytes_sent"),
    with_tables(
        "parsed",
        select="""SELECT event_id, client_ip, http_method, request_path, status_code, bytes_sent
FROM parsed WHERE contains(raw_log, 'id.orig_h')""",
    ),
)
register(
    "p07_strict_status_codes",
    lambda s, d: L.parse_logs(views.raw_logs(s, d), strict=True)
    .groupBy("source_topic", "status_code")
    .agg(F.count("*").alias("n")),
    with_tables(
        "parsed",
        select="""SELECT source_topic,
  CASE WHEN contains(raw_log, 'id.resp_p') THEN '' ELSE status_code END AS status_code, count(*) AS n
FROM parsed GROUP BY ALL""",
    ),
)
register("entry_logs_parsed", lambda s, d: L.to_logs_parsed(parsed(s, d)), with_tables("logs_parsed", select="SELECT * FROM logs_parsed"))

NOISE = [r"cron\[\d+\]: session opened", r"WINHOST Security\[\d+\]"]
register(
    "p23_noise_removed",
    lambda s, d: L.drop_noise(views.raw_logs(s, d), NOISE).groupBy("source_topic").agg(F.count("*").alias("n")),
    with_tables(
        "raw_logs",
        select="""SELECT source_topic, count(*) AS n FROM raw_logs
WHERE NOT (contains(raw_log, ']: session opened') OR contains(raw_log, 'WINHOST Security['))
GROUP BY source_topic""",
    ),
)
register(
    "p23_noise_counts",
    lambda s, d: L.noise_counts(views.raw_logs(s, d), NOISE),
    with_tables(
        "raw_logs",
        select=r"""SELECT pattern, count(*) AS removed_lines FROM (
  SELECT CASE WHEN contains(raw_log, ']: session opened') THEN 'cron\[\d+\]: session opened'
    WHEN contains(raw_log, 'WINHOST Security[') THEN 'WINHOST Security\[\d+\]' END AS pattern FROM raw_logs)
WHERE pattern IS NOT NULL GROUP BY pattern""",
    ),
)
register(
    "p25_json_containment",
    lambda s, d: views.raw_logs(s, d)
    .filter(json_contains(F.col("raw_log"), {"status": "critical"}))
    .select("event_id", "raw_log"),
    with_tables(
        "raw_logs",
        select="""SELECT event_id, raw_log FROM raw_logs
WHERE source_topic = 'app-logs' AND contains(raw_log, '"status":"critical"')""",
    ),
)

# -- rules --------------------------------------------------------------------

HIT_SELECT = "matched_field, matched_value, hit_count"


def _rule(rule_id, threshold=None):
    def run(spark, sf_dir):
        override = {} if threshold is None else {rule_id: threshold}
        rules = R.select_rules(rule_id, thresholds=override)
        return R.rule_hits(prepared.logs_parsed(spark, sf_dir), rules).select(*HIT_SELECT.split(", "))

    return run


_RULE_NAMES = [
    "d1_http_brute_force", "d2_path_traversal", "d3_high_volume", "d4_ssh_brute_force", "d5_sql_injection",
    "d6_app_error_spike", "d7_server_error_spike", "d8_port_scan", "d9_exfiltration",
]
for _name, _rule_row in zip(_RULE_NAMES, RULES):
    register(
        _name,
        _rule(_rule_row[0]),
        with_tables("logs_parsed", select=f"SELECT {HIT_SELECT} FROM ({rule_select(_rule_row)})"),
    )
register(
    "d8_port_scan_low_threshold",
    _rule("SIEM-008", 10),
    with_tables("logs_parsed", select=f"SELECT {HIT_SELECT} FROM ({rule_select(RULES[7], having='> 10')})"),
)
register(
    "d9b_internal_exfiltration",
    lambda s, d: R.internal_exfiltration(prepared.network_flows(s, d)),
    with_tables(
        "featured",
        select="""SELECT 'src_ip' AS matched_field, src_ip AS matched_value, CAST(sum(orig_bytes) AS BIGINT) AS hit_count
FROM featured WHERE is_dst_external = 1 AND (src_ip LIKE '10.%' OR src_ip LIKE '192.168.%')
GROUP BY src_ip HAVING sum(orig_bytes) > 100000000""",
    ),
)
register(
    "d10_rule_engine",
    lambda s, d: R.rule_hits(prepared.logs_parsed(s, d)),
    with_tables("hits", select="SELECT * FROM hits"),
)
USER_RULE = R.SqlRule(
    "USER-001", "Wide paths", "LOW", "Paths requested by more than one address",
    """SELECT 'request_path' AS matched_field, request_path AS matched_value, count(DISTINCT client_ip) AS hit_count
       FROM batch_logs WHERE source_topic = 'web-logs' GROUP BY request_path HAVING count(DISTINCT client_ip) > 1""",
)
register(
    "d10_user_sql_rule",
    lambda s, d: R.rule_hits(prepared.logs_parsed(s, d), (*R.select_rules("SIEM-002"), USER_RULE)),
    with_tables(
        "logs_parsed",
        select=rule_select(RULES[1])
        + """ UNION ALL SELECT 'USER-001', 'Wide paths', 'LOW', 'Paths requested by more than one address',
  'request_path', request_path, count(DISTINCT client_ip) FROM logs_parsed
  WHERE source_topic = 'web-logs' GROUP BY request_path HAVING count(DISTINCT client_ip) > 1""",
    ),
)
register(
    "d11_error_rate_alarm",
    lambda s, d: R.error_rate_alarm(prepared.logs_parsed(s, d), as_of(), "5 MINUTES"),
    with_tables(
        "logs_parsed",
        select=f"""SELECT err_count, err_count > 50 AS triggered FROM (SELECT count(*) AS err_count FROM logs_parsed
WHERE status_code >= '500' AND ingest_ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 MINUTE)""",
    ),
)
ALERT_COLUMNS = (
    "rule_id, rule_name, severity, description, matched_field, matched_value, hit_count, country, city, "
    "detected_at, detect_date"
)
register(
    "p22_alert_enrichment",
    lambda s, d: R.evaluate_rules(prepared.logs_parsed(s, d), detected_at=prepared.detected_at()),
    with_tables("alerts", select=f"SELECT {ALERT_COLUMNS} FROM alerts"),
)
register(
    "j1_alert_location_join",
    lambda s, d: R.locate_hits(R.rule_hits(prepared.logs_parsed(s, d)), prepared.logs_parsed(s, d)).select(
        "rule_id", "matched_value", "country", "city"
    ),
    with_tables("alerts", select="SELECT rule_id, matched_value, country, city FROM alerts"),
)
register(
    "o4_distinct_client_places",
    lambda s, d: prepared.logs_parsed(s, d).select("client_ip", "country", "city").distinct(),
    with_tables("logs_parsed", select="SELECT DISTINCT client_ip, country, city FROM logs_parsed"),
)

# -- log queries --------------------------------------------------------------


def _count_by(keys, n, where="", having="", limit=None):
    tail = f" ORDER BY {n} DESC, {keys} LIMIT {limit}" if limit else ""
    return with_tables(
        "logs_parsed",
        select=f"SELECT {keys}, count(*) AS {n} FROM logs_parsed {where} GROUP BY {keys} {having}{tail}",
    )


def _logs(fn, *args):
    return lambda s, d: fn(prepared.logs_parsed(s, d), *[a() if callable(a) else a for a in args])


register("q11_events_per_topic", _logs(D.events_per_topic), _count_by("source_topic", "event_count"))
register(
    "q12_top_error_sources", _logs(D.top_error_sources),
    _count_by("client_ip", "error_count", "WHERE status_code IN ('404','403')", limit=10),
)
register(
    "q13_heavy_posters", _logs(D.heavy_posters),
    _count_by("client_ip", "post_count", "WHERE http_method = 'POST'", "HAVING count(*) > 100"),
)
register(
    "q14_failed_logins", _logs(D.failed_logins),
    _count_by(
        "syslog_host", "failure_count",
        "WHERE raw_log LIKE '%Failed password%' OR raw_log LIKE '%authentication failure%'",
    ),
)
register(
    "q15_program_activity", _logs(D.program_activity),
    _count_by("syslog_program", "activity_count", "WHERE syslog_program IS NOT NULL"),
)
register(
    "q16_service_errors", _logs(D.service_errors),
    _count_by("app_service, app_event", "event_count", "WHERE app_event IN ('error','critical')"),
)
register(
    "q17_hourly_trend", _logs(D.hourly_trend),
    with_tables(
        "logs_parsed",
        select="""SELECT date_trunc('hour', ingest_ts) AS window_start,
  date_trunc('hour', ingest_ts) + INTERVAL 1 HOUR AS window_end, count(*) AS event_count
FROM logs_parsed GROUP BY 1, 2""",
    ),
)
register("q18_daily_volume", _logs(D.daily_volume), _count_by("ingest_date", "daily_total"))
register(
    "q19_latest_logs", _logs(D.latest_logs),
    with_tables("logs_parsed", select="SELECT * FROM logs_parsed ORDER BY ingest_ts DESC, raw_log LIMIT 20"),
)
register(
    "q20_top_client_errors", _logs(D.top_client_errors),
    _count_by(
        "client_ip", "error_count",
        "WHERE source_topic = 'web-logs' AND status_code IN ('400','401','403','404','429')", limit=25,
    ),
)
register(
    "q21_method_share", _logs(D.method_share),
    with_tables(
        "logs_parsed",
        select=f"""SELECT http_method, n AS request_count, {rnd('n*100.0/sum(n) OVER ()', 2)} AS pct
FROM (SELECT http_method, count(*) AS n FROM logs_parsed WHERE source_topic = 'web-logs' GROUP BY http_method)""",
    ),
)
register(
    "q22_post_brute_force", _logs(D.post_brute_force, today, 28, 200),
    _count_by(
        "client_ip", "post_count",
        f"WHERE source_topic = 'web-logs' AND http_method = 'POST' AND ingest_date >= DATE '{TODAY}' - 28",
        "HAVING count(*) > 200",
    ),
)
register(
    "q23_top_paths", _logs(D.top_paths),
    _count_by("request_path", "hit_count", "WHERE source_topic = 'web-logs'", limit=20),
)
register(
    "q24_auth_failures", _logs(D.auth_failures),
    _count_by(
        "syslog_host", "failure_count",
        "WHERE source_topic = 'syslogs' AND (raw_log LIKE '%Failed password%' "
        "OR raw_log LIKE '%authentication failure%' OR raw_log LIKE '%Invalid user%')",
    ),
)
register(
    "q25_top_programs", _logs(D.top_programs),
    _count_by("syslog_program", "activity_count", "WHERE source_topic = 'syslogs' AND syslog_program <> ''", limit=15),
)
register(
    "q26_app_status", _logs(D.app_status),
    with_tables(
        "logs_parsed",
        select="""SELECT app_event AS status_code, count(*) AS "count" FROM logs_parsed
WHERE source_topic = 'app-logs' AND app_event IS NOT NULL GROUP BY app_event""",
    ),
)
register(
    "q27_top_endpoints", _logs(D.top_endpoints),
    with_tables(
        "logs_parsed",
        select="""SELECT app_service AS endpoint, count(*) AS hit_count FROM logs_parsed
WHERE source_topic = 'app-logs' AND app_service IS NOT NULL GROUP BY app_service
ORDER BY hit_count DESC, endpoint LIMIT 20""",
    ),
)
register(
    "q28_hourly_by_topic", _logs(D.hourly_by_topic, today),
    with_tables(
        "logs_parsed",
        select=f"""SELECT strftime(ingest_ts, '%Y-%m-%d %H:00') AS hour_bucket, source_topic, count(*) AS event_count
FROM logs_parsed WHERE ingest_date >= DATE '{TODAY}' - 1 GROUP BY 1, 2""",
    ),
)
register(
    "q29_daily_trend", _logs(D.daily_trend, today),
    _count_by("ingest_date", "daily_total", f"WHERE ingest_date >= DATE '{TODAY}' - 7"),
)
register(
    "q30_unauthorized_by_ip", _logs(D.unauthorized_by_ip),
    with_tables(
        "logs_parsed",
        select="""SELECT client_ip, count(*) AS "count" FROM logs_parsed WHERE status_code = '401' GROUP BY client_ip""",
    ),
)
register(
    "q31_recent_event_count", _logs(D.recent_event_count, as_of, "5 MINUTES"),
    with_tables(
        "logs_parsed",
        select=f"""SELECT count(*) AS event_count FROM logs_parsed
WHERE ingest_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 5 MINUTE""",
    ),
)
register(
    "q32_missing_paths_of_ip", _logs(D.missing_paths_of, "17.5.5.100"),
    with_tables(
        "logs_parsed",
        select="SELECT request_path FROM logs_parsed WHERE client_ip = '17.5.5.100' AND status_code = '404'",
    ),
)


def _count_of(table):
    return with_tables(table, select=f'SELECT count(*) AS "count" FROM {table}')


register("q35_alert_count", lambda s, d: D.alert_count(prepared.alerts(s, d)), _count_of("alerts"))
register("q36_log_volume", _logs(D.log_volume), _count_of("logs_parsed"))
register(
    "q38_events_per_second", _logs(D.events_per_second),
    with_tables(
        "logs_parsed",
        select="""SELECT date_trunc('second', ingest_ts) AS bucket, count(*) AS "count" FROM logs_parsed GROUP BY 1""",
    ),
)
register(
    "q40_alerts_by_severity", lambda s, d: D.alerts_by_severity(prepared.alerts(s, d)),
    with_tables("alerts", select='SELECT severity, count(*) AS "count" FROM alerts GROUP BY severity'),
)
register("q41_logs_by_topic", _logs(D.events_per_topic), _count_by("source_topic", "event_count"))
register(
    "q44_alert_feed", lambda s, d: D.alert_feed(prepared.alerts(s, d)),
    with_tables(
        "alerts",
        select="SELECT detected_at, rule_name, severity, matched_field, matched_value, hit_count, country FROM alerts",
    ),
)
register(
    "q47_logs_at_time",
    lambda s, d: X.at_time(prepared.logs_parsed(s, d), as_of()).groupBy("source_topic").agg(F.count("*").alias("n")),
    with_tables(
        "logs_parsed",
        select=f"SELECT source_topic, count(*) AS n FROM logs_parsed WHERE ingest_ts <= TIMESTAMP '{AS_OF}' GROUP BY 1",
    ),
)
register(
    "w2_hourly_vs_last_week", _logs(D.hourly_vs_last_week),
    with_tables(
        "logs_parsed",
        select="""SELECT a.hour, a.event_count, b.event_count AS earlier_count FROM hours a
LEFT JOIN hours b ON a.hour = b.hour + INTERVAL 7 DAY""",
        extra={"hours": "SELECT date_trunc('hour', ingest_ts) AS hour, count(*) AS event_count FROM logs_parsed GROUP BY 1"},
    ),
)

# -- predicates ---------------------------------------------------------------

register(
    "f6_text_ordering",
    _logs(lambda logs: logs.filter(F.col("status_code") >= "500").groupBy("status_code").agg(F.count("*").alias("n"))),
    _count_by("status_code", "n", "WHERE status_code >= '500'"),
)
register(
    "f8_time_between",
    _logs(
        lambda logs: logs.filter(
            F.col("ingest_date").between(F.lit("2024-01-03").cast("date"), F.lit("2024-01-05").cast("date"))
            & F.col("ingest_ts").between(
                F.to_timestamp(F.lit("2024-01-03 06:00:00")), F.to_timestamp(F.lit("2024-01-05 18:00:00"))
            )
        ).groupBy("ingest_date").agg(F.count("*").alias("n"))
    ),
    _count_by(
        "ingest_date", "n",
        "WHERE ingest_ts BETWEEN TIMESTAMP '2024-01-03 06:00:00' AND TIMESTAMP '2024-01-05 18:00:00'",
    ),
)
register(
    "t10_windowed_rules",
    lambda s, d: R.windowed_hits(
        prepared.logs_parsed(s, d), R.select_rules(thresholds=WINDOW_THRESHOLDS), "1 day"
    ).drop("rule_name", "severity", "description"),
    with_tables(
        "logs_parsed",
        select="SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, rule_id, matched_field, "
        "matched_value, hit_count FROM (" + " UNION ALL ".join(
            rule_select(r, "dated", "window_start, ", having=h) for r, h in zip(RULES, (
                "> 5", "> 0", "> 30", "> 3", "> 0", "> 2", "> 4", "> 5", "> 1000000"))
        ) + ")",
        extra={"dated": "SELECT *, date_trunc('day', ingest_ts) AS window_start FROM logs_parsed"},
    ),
)
WINDOW_THRESHOLDS = {
    "SIEM-001": 5, "SIEM-003": 30, "SIEM-004": 3, "SIEM-006": 2, "SIEM-007": 4, "SIEM-008": 5, "SIEM-009": 1_000_000,
}

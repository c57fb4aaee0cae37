"""Rules on literal logs, thresholds, user rules, location of alerts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loghaven.operators import rules as R
from loghaven.schemas import ALERTS

TS = dt.datetime(2024, 5, 6, 7, 8, 9)
COLUMNS = (
    "source_topic string, client_ip string, status_code string, request_path string, raw_log string, "
    "syslog_host string, app_event string, app_service string, dest_port string, orig_bytes bigint, "
    "country string, city string, ingest_ts timestamp, ingest_date date"
)


def logs(spark, rows):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    base = {"ingest_ts": TS, "ingest_date": TS.date(), "country": "Unknown", "city": "Unknown", "raw_log": ""}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], COLUMNS)


def hits(spark, rows, *rule_ids, **kw):
    found = R.rule_hits(logs(spark, rows), R.select_rules(*rule_ids, **kw)).collect()
    return {(r.rule_id, r.matched_value): r.hit_count for r in found}


def web(**kw):
    return {"source_topic": "web-logs", "client_ip": "1.1.1.1", **kw}


def test_thresholds_are_strict(spark):
    rows = [web(status_code="401")] * 50
    assert hits(spark, rows, "SIEM-001") == {}
    assert hits(spark, rows + [web(status_code="403")], "SIEM-001") == {("SIEM-001", "1.1.1.1"): 51}


def test_empty_and_null_addresses_do_not_count(spark):
    rows = [web(client_ip="", status_code="401")] * 60 + [web(client_ip=None, status_code="401")] * 60
    assert hits(spark, rows, "SIEM-001") == {}


def test_paths(spark):
    rows = [web(request_path=p) for p in (
        "/a/../b", "/ok", "/q=UNION ALL SELECT", "/x OR 1=1", "/y' OR 'a", "/DROP TABLE t", "/union select",
    )]
    assert {k[1] for k in hits(spark, rows, "SIEM-002")} == {"/a/../b"}
    assert {k[1] for k in hits(spark, rows, "SIEM-005")} == {
        "/q=UNION ALL SELECT", "/x OR 1=1", "/y' OR 'a", "/DROP TABLE t",
    }


def test_empty_syslog_host_is_a_group(spark):
    rows = [{"source_topic": "syslogs", "raw_log": "Failed password", "syslog_host": ""}] * 11
    assert hits(spark, rows, "SIEM-004") == {("SIEM-004", ""): 11}


def test_port_scan_counts_distinct_ports(spark):
    flow = {"source_topic": "real_network_logs", "client_ip": "9.9.9.9"}
    rows = [{**flow, "dest_port": str(p % 51)} for p in range(200)]
    assert hits(spark, rows, "SIEM-008") == {("SIEM-008", "9.9.9.9"): 51}
    assert hits(spark, rows[:50], "SIEM-008") == {}


def test_exfiltration_skips_internal_sources(spark):
    flow = {"source_topic": "real_network_logs", "orig_bytes": 60_000_000}
    rows = [{**flow, "client_ip": "10.0.0.50", "country": "Internal"}] * 2 + [
        {**flow, "client_ip": "8.8.8.8"}, {**flow, "client_ip": "8.8.8.8"},
        {**flow, "client_ip": "7.7.7.7", "orig_bytes": None},
    ]
    assert hits(spark, rows, "SIEM-009") == {("SIEM-009", "8.8.8.8"): 120_000_000}


def test_internal_exfiltration(spark):
    flows = spark.createDataFrame(
        [("10.0.0.50", "8.8.8.8", 60_000_000)] * 2 + [("10.0.0.50", "10.0.0.1", 900_000_000), ("8.8.8.8", "9.9.9.9", 900_000_000)],
        "src_ip string, dest_ip string, orig_bytes bigint",
    )
    assert R.internal_exfiltration(flows).collect() == [("src_ip", "10.0.0.50", 120_000_000)]


def test_other_rules_and_one_pass_equals_single_rules(spark):
    rows = (
        [{"source_topic": "app-logs", "app_event": "error", "app_service": "s"}] * 6
        + [web(status_code="503")] * 21
        + [web(status_code="200")] * 1000
    )
    together = hits(spark, rows)
    assert together == {("SIEM-003", "1.1.1.1"): 1021, ("SIEM-006", "s"): 6, ("SIEM-007", "503"): 21}
    single = {}
    for rule in R.DEFAULT_RULES:
        single.update(hits(spark, rows, rule.rule_id))
    assert single == together


def test_threshold_override(spark):
    assert hits(spark, [web(status_code="401")] * 3, "SIEM-001", thresholds={"SIEM-001": 2}) == {("SIEM-001", "1.1.1.1"): 3}


def test_user_rules(spark):
    odd = R.Rule("U-1", "It's \\ odd", "LOW", 'quotes "and" more', "status_code",
                 condition=lambda: F.col("status_code") == "418")
    sql = R.SqlRule("U-2", "n", "INFO", "d", "SELECT 'client_ip' AS matched_field, client_ip AS matched_value, "
                    "count(*) AS hit_count FROM batch_logs GROUP BY client_ip")
    found = {r.rule_id: r for r in R.rule_hits(logs(spark, [web(status_code="418")]), [odd, sql]).collect()}
    assert (found["U-1"].rule_name, found["U-1"].description) == ("It's \\ odd", 'quotes "and" more')
    assert found["U-2"].hit_count == 1
    with pytest.raises(ValueError):
        R.Rule("U", "n", "URGENT", "d", "f", condition=lambda: F.lit(True))


def test_alerts_are_located_by_any_matching_address(spark):
    rows = [web(client_ip="17.1.1.1", status_code="401", country="United States", city="New York")] * 51
    rows += [web(client_ip="503", status_code="503")] * 21 + [web(client_ip="x", request_path="/../")]
    alerts = R.evaluate_rules(logs(spark, rows), detected_at=F.lit(TS))
    assert [(f.name, f.dataType) for f in alerts.schema] == [(f.name, f.dataType) for f in ALERTS]
    found = {r.rule_id: (r.country, r.city, r.detected_at, r.detect_date) for r in alerts.collect()}
    assert found["SIEM-001"] == ("United States", "New York", TS, TS.date())
    assert found["SIEM-007"][:2] == ("Unknown", "Unknown")  # some row has the text 503 as its address
    assert found["SIEM-002"][:2] == (None, None)


def test_windowed_rules(spark):
    early, late = TS, TS + dt.timedelta(minutes=10)
    rows = [web(status_code="401", ingest_ts=early)] * 30 + [web(status_code="401", ingest_ts=late)] * 60
    found = R.windowed_hits(logs(spark, rows), R.select_rules("SIEM-001")).collect()
    assert [(r.window_start, r.hit_count) for r in found] == [(dt.datetime(2024, 5, 6, 7, 15), 60)]


def test_error_rate_alarm(spark):
    as_of = F.lit(TS + dt.timedelta(minutes=1))
    rows = [web(status_code=c) for c in ("500", "503", "53", "", None, "404")]
    rows.append(web(status_code="500", ingest_ts=TS - dt.timedelta(hours=1)))
    assert R.error_rate_alarm(logs(spark, rows), as_of, threshold=2).collect() == [(3, True)]
    assert R.error_rate_alarm(logs(spark, rows), as_of).collect() == [(3, False)]

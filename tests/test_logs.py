"""Parsing and enrichment of literal log lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loghaven.functions.jsonx import json_contains, json_object
from loghaven.operators.logs import (
    drop_noise, log_base, noise_counts, parse_logs, to_logs_parsed,
)
from loghaven.schemas import LOGS_PARSED

TS = dt.datetime(2024, 5, 6, 7, 8, 9)


def parse(spark, topic, line, **kw):
    logs = spark.createDataFrame([(topic, TS, line)], "source_topic string, kafka_ts timestamp, raw_log string")
    return parse_logs(logs, **kw).first()


def test_access_line(spark):
    r = parse(spark, "web-logs", '1.2.3.4 - - [06/May/2024:07:08:09 +0000] "GET /a/../b HTTP/1.1" 404 123')
    assert (r.client_ip, r.http_method, r.request_path, r.status_code, r.bytes_sent) == (
        "1.2.3.4", "GET", "/a/../b", "404", "123",
    )
    assert r.ingest_ts == TS and r.ingest_date == TS.date() and r.detect_date == TS.date()


def test_missing_bytes_and_post(spark):
    r = parse(spark, "web-logs", '1.2.3.4 - - [x] "POST /q?x=UNION+SELECT HTTP/1.1" 500 -')
    assert (r.http_method, r.request_path, r.status_code, r.bytes_sent) == ("POST", "/q?x=UNION+SELECT", "500", "")


def test_line_without_request_yields_empty_text_not_null(spark):
    r = parse(spark, "web-logs", "nothing quoted here")
    assert (r.client_ip, r.http_method, r.request_path, r.status_code) == ("nothing", "", "", "")
    assert r.dest_port is None and r.orig_bytes is None and r.app_event is None


@pytest.mark.parametrize(
    "line, host, program, strict_program",
    [
        ("Jan  5 01:02:03 host1 sshd[77]: Failed password", "host1", "01", "sshd"),
        ("Jan 15 01:02:03 host2 cron: session opened", "host2", "01", "cron"),
        ("host3 kernel[1]: up", "", "kernel", ""),
        ("no syslog at all", "", "", ""),
    ],
)
def test_syslog(spark, line, host, program, strict_program):
    r = parse(spark, "syslogs", line)
    assert (r.syslog_host, r.syslog_program) == (host, program)
    assert parse(spark, "syslogs", line, strict=True).syslog_program == strict_program


def test_windows_source_overrides_event(spark):
    line = "Jan  5 01:02:03 H Security[9]: logon"
    assert parse(spark, "win-event-logs", line).app_event == "01"
    assert parse(spark, "win-event-logs", line, strict=True).app_event == "Security"
    assert parse(spark, "win-event-logs", "H Security[9]: logon").app_event == "Security"
    assert parse(spark, "syslogs", line).app_event is None


def test_app_json(spark):
    r = parse(spark, "app-logs", '{"host":"10.0.0.1","request":"svc","status":"error","bytes":12}')
    assert (r.app_event, r.app_service, r.bytes_sent) == ("error", "svc", "12")


def test_sensor_json_in_parity_and_strict_mode(spark):
    line = '{"id.orig_h":"10.1.1.1","id.resp_p":53,"query":"h.example","orig_bytes":"77"}'
    r = parse(spark, "dns-logs", line)
    assert (r.client_ip, r.request_path, r.status_code, r.dest_port, r.orig_bytes) == (
        "10.1.1.1", "h.example", "53", "53", 77,
    )
    assert parse(spark, "dns-logs", line, strict=True).status_code == ""


def test_http_sensor_json(spark):
    line = '{"id.orig_h":"9.9.9.9","id.resp_p":80,"method":"GET","uri":"/u","status_code":200,"response_body_len":9}'
    r = parse(spark, "web-logs", line)
    assert (r.http_method, r.request_path, r.status_code, r.bytes_sent, r.dest_port) == ("GET", "/u", "200", "9", "80")


def test_url_that_names_a_field(spark):
    line = '1.1.1.1 - - [x] "GET /q?orig_bytes=5&dest_port=9 HTTP/1.1" 200 5'
    assert parse(spark, "web-logs", line).orig_bytes is None
    assert parse(spark, "web-logs", line, strict=True).client_ip == "1.1.1.1"


@pytest.mark.parametrize("line", ["{broken", "", "[1,2]", '"text"', None, '{"a":1'])
def test_malformed_text_does_not_fail(spark, line):
    r = parse(spark, "app-logs", line)
    assert r.app_event is None and r.raw_log == line


def test_bad_number_is_null_under_ansi(spark):
    assert parse(spark, "real_network_logs", '{"id.orig_h":"1.1.1.1","orig_bytes":"-"}').orig_bytes is None


@pytest.mark.parametrize(
    "ip, country, city, tag",
    [
        ("192.0.2.1", "Internal", "Unknown", "Clean"),
        ("10.1.1.1", "Internal", "Unknown", "Clean"),
        ("172.16.0.1", "United States", "New York", "Clean"),
        ("172.32.0.1", "United States", "New York", "Clean"),
        ("210.1.1.1", "China", "Beijing", "Clean"),
        ("95.1.1.200", "Russia", "Moscow", "Tor Exit Node"),
        ("17.5.5.100", "United States", "New York", "Known Malicious IP"),
        ("41.2.3.4", "Germany", "Frankfurt", "Clean"),
        ("8.8.8.8", "Unknown", "Unknown", "Clean"),
        ("100.1.1.1", "Unknown", "Unknown", "Clean"),
    ],
)
def test_enrichment(spark, ip, country, city, tag):
    r = parse(spark, "web-logs", f'{ip} - - [x] "GET / HTTP/1.1" 200 1')
    assert (r.country, r.city, r.intelligence_tag) == (country, city, tag)


def test_missing_arrival_time_takes_now(spark):
    logs = spark.createDataFrame([("syslogs", None, "x")], "source_topic string, kafka_ts timestamp, raw_log string")
    r = parse_logs(logs, now=F.lit(TS)).first()
    assert r.ingest_ts == TS


def test_table_projection_and_base(spark):
    records = spark.createDataFrame(
        [("syslogs", TS, bytearray(b"line"))], "topic string, timestamp timestamp, value binary"
    )
    base = log_base(records)
    assert base.first() == ("syslogs", TS, "line")
    table = to_logs_parsed(parse_logs(base))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in LOGS_PARSED]


def test_noise(spark):
    lines = spark.createDataFrame([("keep",), ("warn 1",), ("warn 2",), (None,), ("old auth",)], "raw_log string")
    patterns = [r"warn \d", "old"]
    assert drop_noise(lines, patterns).count() == 2
    assert {r.pattern: r.removed_lines for r in noise_counts(lines, patterns).collect()} == {patterns[0]: 2, "old": 1}


@pytest.mark.parametrize(
    "text, wanted, found",
    [
        ('{"status":"malicious","n":1}', {"status": "malicious"}, True),
        ('{"status":"ok"}', {"status": "malicious"}, False),
        ('{"a":{"b":{"c":1}}}', {"a": {"b": {"c": 1}}}, True),
        ('{"a":"1"}', {"a": 1}, False),
        ('{"a":1}', {"a": "1"}, False),
        ('{"id.orig_h":"x"}', {"id.orig_h": "x"}, True),
        ('{"a":true}', {"a": True}, True),
        ('{"a":null}', {"a": None}, True),
        ("{}", {"a": None}, False),
        ("not json", {"a": 1}, False),
    ],
)
def test_json_containment(spark, text, wanted, found):
    row = spark.createDataFrame([(text,)], "c string").select(json_contains(F.col("c"), wanted).alias("r")).first()
    assert row.r is found


@pytest.mark.parametrize(
    "text, valid",
    [('{"a":1}', True), (' {"a":1} ', True), ('{"a":1} x', False), ("12 abc", False), ('{"a":1},{"b":2}', False), ("12", False)],
)
def test_json_object_must_be_the_whole_text(spark, text, valid):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(json_object(F.col("c")).isNotNull().alias("r")).first().r is valid

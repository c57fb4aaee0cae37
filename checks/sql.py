"""Common table expressions, in DuckDB SQL, that restate the views and tables independently."""

from __future__ import annotations

AS_OF = "2024-01-15 12:00:00"
TODAY = "2024-01-29"
DETECTED_AT = "2024-01-31 00:00:00"


def rnd(value: str, digits: int) -> str:
    """Half-up rounding through a twelve-digit decimal, as DOUBLE."""
    return f"CAST(round(CAST(CAST({value} AS DOUBLE) AS DECIMAL(30,12)), {digits}) AS DOUBLE)"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}

_CTES["raw_logs"] = ((), """
  SELECT event_id, source_topic, ts AS kafka_ts,
    CASE source_topic
      WHEN 'web-logs' THEN concat(ip, ' - - [01/Jan/2024:00:00:00 +0000] "',
        CASE k%4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' ELSE 'DELETE' END, ' ',
        CASE k%20 WHEN 3 THEN '/a/../../etc/passwd' WHEN 7 THEN '/q?x=UNION+SELECT' ELSE concat('/p/', k%10) END,
        ' HTTP/1.1" ',
        CASE k%8 WHEN 1 THEN '401' WHEN 2 THEN '403' WHEN 3 THEN '404' WHEN 4 THEN '500'
             WHEN 5 THEN '503' WHEN 6 THEN '301' ELSE '200' END, ' ',
        CASE WHEN k%13=0 THEN '-' ELSE CAST(b AS VARCHAR) END)
      WHEN 'syslogs' THEN concat('Jan  5 01:02:03 host', user_id%5,
        CASE WHEN k%2=0 THEN concat(' sshd[', k, ']: Failed password for root')
             ELSE concat(' cron[', k, ']: session opened') END)
      WHEN 'win-event-logs' THEN concat('Jan  5 01:02:03 WINHOST Security[', k, ']: logon')
      WHEN 'app-logs' THEN concat('{"host":"', ip, '","request":"svc-', k%6, '","status":"',
        CASE k%3 WHEN 0 THEN 'error' WHEN 1 THEN 'critical' ELSE 'ok' END, '","bytes":', b, '}')
      WHEN 'dns-logs' THEN concat('{"id.orig_h":"', ip,
        '","id.resp_h":"8.8.8.8","id.resp_p":53,"proto":"udp","query":"h', k, '.example.com"}')
      ELSE concat('{"uid":"C', event_id, '","id.orig_h":"', ip, '","id.resp_h":"52.0.0.', k,
        '","id.resp_p":', k+20, ',"proto":"tcp","service":"http","duration":"0.5","orig_bytes":', b*10, '}')
    END AS raw_log
  FROM (
    SELECT *,
      CASE event_type WHEN 'view' THEN 'web-logs' WHEN 'error' THEN 'syslogs'
        WHEN 'purchase' THEN 'app-logs' WHEN 'signup' THEN 'win-event-logs'
        ELSE CASE k%10 WHEN 9 THEN 'dns-logs' WHEN 8 THEN 'ssl-logs' WHEN 7 THEN 'ssh-logs'
             ELSE 'real_network_logs' END END AS source_topic,
      CASE WHEN user_id%8<5 THEN '17.5.5.100' WHEN user_id%8=5 THEN concat('10.0.0.', user_id)
        WHEN user_id%8=6 THEN '95.1.1.200' ELSE concat('41.2.3.', user_id) END AS ip
    FROM (
      SELECT event_id, ts, user_id, event_type,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
        CAST(floor(value*1000) AS BIGINT) AS b
      FROM events))
""")


def _json(name: str) -> str:
    return f"""json_extract_string(js, '$."{name}"')"""


_CTES["parsed"] = (("raw_logs",), f"""
  SELECT event_id, source_topic, kafka_ts, raw_log, client_ip, http_method, request_path, status_code,
    bytes_sent, syslog_host, syslog_program, app_event, app_service, dest_port, orig_bytes,
    country,
    CASE country WHEN 'United States' THEN 'New York' WHEN 'Germany' THEN 'Frankfurt'
      WHEN 'Russia' THEN 'Moscow' WHEN 'China' THEN 'Beijing' ELSE 'Unknown' END AS city,
    CASE WHEN regexp_matches(client_ip, '[.]100$') THEN 'Known Malicious IP'
      WHEN regexp_matches(client_ip, '[.]200$') THEN 'Tor Exit Node' ELSE 'Clean' END AS intelligence_tag,
    kafka_ts AS ingest_ts, CAST(kafka_ts AS DATE) AS ingest_date
  FROM (
    SELECT *,
      CASE WHEN client_ip LIKE '192.%' OR client_ip LIKE '10.%' THEN 'Internal'
        WHEN regexp_matches(client_ip, '^1[7-8]') THEN 'United States'
        WHEN regexp_matches(client_ip, '^4[0-5]') THEN 'Germany'
        WHEN regexp_matches(client_ip, '^9[0-5]') THEN 'Russia'
        WHEN regexp_matches(client_ip, '^2[1-2]') THEN 'China' ELSE 'Unknown' END AS country
    FROM (
      SELECT *,
        CASE WHEN contains(raw_log, 'id.orig_h') THEN {_json('id.orig_h')}
          ELSE regexp_extract(raw_log, '^([^ ]+)', 1) END AS client_ip,
        CASE WHEN contains(raw_log, '"method"') THEN {_json('method')}
          ELSE regexp_extract(raw_log, '"(GET|POST|PUT|DELETE|PATCH|OPTIONS|HEAD) ', 1) END AS http_method,
        CASE WHEN contains(raw_log, '"uri"') THEN {_json('uri')}
          WHEN contains(raw_log, '"query"') THEN {_json('query')}
          ELSE regexp_extract(raw_log, '"(GET|POST|PUT|DELETE|PATCH|OPTIONS|HEAD) +([^ ]+)', 2) END AS request_path,
        CASE WHEN contains(raw_log, '"status_code"') THEN {_json('status_code')}
          WHEN contains(raw_log, 'id.resp_p') THEN {_json('id.resp_p')}
          ELSE regexp_extract(raw_log, '" +([0-9][0-9][0-9]) +', 1) END AS status_code,
        CASE WHEN contains(raw_log, '"response_body_len"') THEN {_json('response_body_len')}
          WHEN contains(raw_log, '"bytes"') THEN {_json('bytes')}
          ELSE regexp_extract(raw_log, '" +[0-9][0-9][0-9] +([0-9]+)', 1) END AS bytes_sent,
        regexp_extract(raw_log, '^[A-Za-z0-9_][A-Za-z0-9_][A-Za-z0-9_] +[0-9]+ +[0-9]+:[0-9]+:[0-9]+ +([^ ]+)', 1)
          AS syslog_host,
        regexp_extract(raw_log, ' ([A-Za-z0-9_.-]+)([[][0-9]+[]])?:', 1) AS syslog_program,
        CASE WHEN source_topic = 'win-event-logs'
          THEN regexp_extract(raw_log, ' ([A-Za-z0-9-]+)([[][0-9]+[]])?:', 1)
          ELSE {_json('status')} END AS app_event,
        {_json('request')} AS app_service,
        CASE WHEN contains(raw_log, 'id.resp_p') THEN {_json('id.resp_p')}
          WHEN contains(raw_log, 'dest_port') THEN {_json('dest_port')} END AS dest_port,
        CASE WHEN contains(raw_log, 'orig_bytes') THEN TRY_CAST({_json('orig_bytes')} AS BIGINT) END AS orig_bytes
      FROM (SELECT *, CASE WHEN json_valid(raw_log) THEN raw_log END AS js FROM raw_logs)))
""")

LOG_COLUMNS = (
    "raw_log, source_topic, client_ip, http_method, request_path, status_code, bytes_sent, syslog_host, "
    "syslog_program, app_event, app_service, country, city, intelligence_tag, dest_port, orig_bytes, "
    "ingest_ts, ingest_date"
)
_CTES["logs_parsed"] = (("parsed",), f"SELECT {LOG_COLUMNS} FROM parsed")

# id, name, severity, description, field, condition, measure, having
RULES = [
    ("SIEM-001", "Brute Force Detection (HTTP)", "HIGH",
     "Single IP generating 50+ HTTP 401/403 errors in a micro-batch", "client_ip",
     "source_topic = 'web-logs' AND status_code IN ('401','403') AND client_ip <> ''", "count(*)", "> 50"),
    ("SIEM-002", "Path Traversal Attempt", "CRITICAL",
     "URL containing ../ patterns indicating directory traversal attack", "request_path",
     "source_topic = 'web-logs' AND contains(request_path, '../')", "count(*)", "> 0"),
    ("SIEM-003", "Unusual High Volume from Single IP", "MEDIUM",
     "Single IP generating 1000+ requests in a micro-batch (potential DDoS)", "client_ip",
     "source_topic = 'web-logs' AND client_ip <> ''", "count(*)", "> 1000"),
    ("SIEM-004", "SSH Brute Force (Syslog)", "HIGH",
     "Repeated 'Failed password' patterns in syslog indicating SSH brute force", "syslog_host",
     "source_topic = 'syslogs' AND contains(raw_log, 'Failed password') AND syslog_host IS NOT NULL",
     "count(*)", "> 10"),
    ("SIEM-005", "SQL Injection Attempt", "CRITICAL",
     "URL containing common SQL injection patterns", "request_path",
     "source_topic = 'web-logs' AND (request_path LIKE '%UNION%SELECT%' OR request_path LIKE '%OR%1=1%' "
     "OR request_path LIKE '%''%OR%''%' OR request_path LIKE '%DROP%TABLE%')", "count(*)", "> 0"),
    ("SIEM-006", "Application Critical Error Spike", "HIGH",
     "Multiple critical/error events from an application service", "app_service",
     "source_topic = 'app-logs' AND app_event IN ('error','critical') AND app_service IS NOT NULL",
     "count(*)", "> 5"),
    ("SIEM-007", "HTTP 5xx Server Error Spike", "MEDIUM",
     "High volume of server errors indicating potential service degradation", "status_code",
     "source_topic = 'web-logs' AND starts_with(status_code, '5')", "count(*)", "> 20"),
    ("SIEM-008", "Network Port Scanning", "HIGH",
     "Single internal/external IP scanning multiple distinct ports", "client_ip",
     "source_topic = 'real_network_logs' AND dest_port IS NOT NULL", "count(DISTINCT dest_port)", "> 50"),
    ("SIEM-009", "Potential Data Exfiltration", "CRITICAL",
     "Large data transfer detected from internal network to external IP", "client_ip",
     "source_topic = 'real_network_logs' AND country <> 'Internal'", "sum(orig_bytes)", "> 100000000"),
]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rule_select(rule, source: str = "logs_parsed", keys: str = "", having: str | None = None) -> str:
    rule_id, name, severity, description, field, condition, measure, above = rule
    above = having or above
    group = f"{keys}{field}"
    return (
        f"SELECT {keys}{quoted(rule_id)} AS rule_id, {quoted(name)} AS rule_name, {quoted(severity)} AS severity, "
        f"{quoted(description)} AS description, {quoted(field)} AS matched_field, {field} AS matched_value, "
        f"CAST({measure} AS BIGINT) AS hit_count FROM {source} WHERE {condition} GROUP BY {group} "
        f"HAVING {measure} {above}"
    )


_CTES["hits"] = (("logs_parsed",), "\n  UNION ALL\n  ".join(rule_select(r) for r in RULES))

_CTES["alerts"] = (("hits",), f"""
  SELECT h.*, m.country, m.city, TIMESTAMP '{DETECTED_AT}' AS detected_at, DATE '{DETECTED_AT[:10]}' AS detect_date
  FROM hits h LEFT JOIN (SELECT DISTINCT client_ip, country, city FROM logs_parsed) m ON h.matched_value = m.client_ip
""")

_CTES["flows"] = ((), """
  SELECT concat('C', l_orderkey, '-', l_linenumber) AS uid,
    make_timestamp((1704067200 + (l_orderkey*7919 + l_linenumber*104729) % 2592000) * 1000000) AS kafka_ts,
    CAST(epoch(l_shipdate) AS DOUBLE) AS ts,
    CASE WHEN l_suppkey%10=0 THEN '192.168.1.250' WHEN l_suppkey%10<5 THEN concat('10.0.0.', l_suppkey%250)
         ELSE concat('41.7.0.', l_suppkey%250) END AS src_ip,
    CAST(49152 + l_orderkey%16000 AS INT) AS src_port,
    CASE WHEN l_partkey%4=0 THEN concat('172.16.0.', l_partkey%250) ELSE concat('52.1.0.', l_partkey%250) END AS dest_ip,
    CAST(1 + l_partkey%1024 AS INT) AS dest_port,
    CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' ELSE 'icmp' END AS proto,
    CASE WHEN l_linenumber=7 THEN NULL WHEN l_linenumber%2=0 THEN 'http' ELSE 'dns' END AS service,
    l_quantity/10 AS duration,
    CAST(floor(l_extendedprice*100) AS BIGINT) AS orig_bytes,
    CAST(floor(l_extendedprice*l_discount) AS BIGINT) AS resp_bytes,
    CASE l_linenumber WHEN 2 THEN 'S0' WHEN 3 THEN 'REJ' WHEN 4 THEN 'RSTO' WHEN 5 THEN 'RSTOS0'
         WHEN 6 THEN 'OTH' ELSE 'SF' END AS conn_state
  FROM lineitem
""")

_CTES["featured"] = (("flows",), """
  SELECT f.*, ln(1+duration) AS a, ln(1+orig_bytes) AS b, ln(1+resp_bytes) AS c,
    CASE WHEN regexp_extract(dest_ip, '^(10[.]|192[.]168[.]|172[.](1[6-9]|2[0-9]|3[0-1]))', 0) <> ''
         THEN 0 ELSE 1 END AS is_dst_external,
    CASE WHEN src_ip IN ('192.168.1.250','192.168.1.100') THEN 1 ELSE 0 END AS is_src_server
  FROM flows f
""")

_CTES["scaled"] = (("featured",), """
  SELECT g.*, (a-ma)/sa AS za, (b-mb)/sb AS zb, (c-mc)/sc AS zc,
    (is_dst_external-md)/sd AS zd, (is_src_server-me)/se AS ze
  FROM featured g CROSS JOIN (
    SELECT avg(a) ma, stddev_samp(a) sa, avg(b) mb, stddev_samp(b) sb, avg(c) mc, stddev_samp(c) sc,
      avg(is_dst_external) md, stddev_samp(is_dst_external) sd,
      avg(is_src_server) me, stddev_samp(is_src_server) se FROM featured)
""")

_CTES["network_flows"] = (("scaled",), """
  SELECT kafka_ts, kafka_ts AS ingest_ts, ts, uid, src_ip, src_port, dest_ip, dest_port, proto, service,
    duration, orig_bytes, resp_bytes, conn_state, is_dst_external, is_src_server,
    (CASE WHEN q1<q0 THEN 4 ELSE 0 END)+(CASE WHEN r1<r0 THEN 2 ELSE 0 END)+(CASE WHEN s1<s0 THEN 1 ELSE 0 END)
      AS cluster_id,
    CAST(sqrt(least(q0,q1)+(zc-0.3)*(zc-0.3)+least(r0,r1)+least(s0,s1)) AS FLOAT) AS anomaly_score,
    CAST(CAST(sqrt(least(q0,q1)+(zc-0.3)*(zc-0.3)+least(r0,r1)+least(s0,s1)) AS FLOAT) AS DOUBLE) > 3.0
      AS is_anomaly,
    CAST(kafka_ts AS DATE) AS ingest_date, za, zb, zc, zd, ze
  FROM (
    SELECT *,
      (za-0.5)*(za-0.5)+(zb-0.5)*(zb-0.5) AS q0, (za+1.0)*(za+1.0)+(zb+1.0)*(zb+1.0) AS q1,
      (zd+1.73)*(zd+1.73) AS r0, (zd-0.58)*(zd-0.58) AS r1,
      (ze+0.33)*(ze+0.33) AS s0, (ze-3.0)*(ze-3.0) AS s1 FROM scaled)
""")

_CTES["network_anomalies"] = (("network_flows",), "SELECT * FROM network_flows WHERE is_anomaly")

_CTES["indicators"] = ((), """
  SELECT concat('41.7.0.', s_suppkey%250) AS indicator, n_name AS origin
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0
""")

_CTES["address_ranges"] = ((), """
  SELECT concat('41.7.0.', n_nationkey*8) AS base, 29 AS len, n_name AS area FROM nation
  UNION ALL SELECT concat(40 + r_regionkey, '.0.0.0'), 8, r_name FROM region
  UNION ALL SELECT concat('52.', r_regionkey, '.0.0'), 16, concat(r_name, '-CLOUD') FROM region
""")


def ip_number(ip: str) -> str:
    part = lambda i: f"CAST(split_part({ip}, '.', {i}) AS BIGINT)"
    return f"({part(1)}*16777216 + {part(2)}*65536 + {part(3)}*256 + {part(4)})"


_CTES["places"] = (("address_ranges", "flows"), f"""
  SELECT ip, arg_max(area, len) AS area
  FROM (SELECT DISTINCT src_ip AS ip FROM flows UNION SELECT DISTINCT dest_ip FROM flows) a
  JOIN address_ranges r ON {ip_number('a.ip')} // CAST(2**(32-r.len) AS BIGINT)
                         = {ip_number('r.base')} // CAST(2**(32-r.len) AS BIGINT)
  GROUP BY ip
""")


def _needed(name: str, out: list[str]) -> None:
    for parent in _CTES[name][0]:
        _needed(parent, out)
    if name not in out:
        out.append(name)


def with_tables(*names: str, select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` preceded by the named tables and all they build on."""
    order: list[str] = []
    for n in names:
        _needed(n, order)
    parts = [f"{n} AS ({_CTES[n][1]})" for n in order]
    parts += [f"{n} AS ({body})" for n, body in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + select

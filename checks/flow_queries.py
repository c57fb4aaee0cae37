"""Flow parsing, features, scoring, model checks and forensic queries."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from checks import prepared, views
from checks.log_queries import as_of
from checks.registry import register
from checks.sql import AS_OF, rnd, with_tables
from loghaven.functions.numeric import rounded
from loghaven.operators import anomaly as M
from loghaven.operators import features as P
from loghaven.operators import flows as W
from loghaven.plans import dashboards as D
from loghaven.plans import forensics as X

POINTS = [f"z_{f}" for f in P.FEATURES]
KEY = ["uid", "dest_ip", "dest_port", "orig_bytes"]
KEYS = ", ".join(KEY)


# -- parsing and features -----------------------------------------------------


def flow_json(spark, sf_dir):
    """Flows as JSON records; one in seven lacks a duration, some sources are ``-``."""
    return prepared.flow_json(views.flows(spark, sf_dir))


register(
    "p14_flow_parse",
    lambda s, d: W.parse_flows(flow_json(s, d)).select(
        "kafka_ts", "ts", "event_time", "uid", "src_ip", "src_port", "dest_ip", "dest_port", "proto", "service",
        "duration", "orig_bytes", "resp_bytes", "conn_state",
    ),
    with_tables(
        "flows",
        select="""SELECT kafka_ts, ts, make_timestamp(CAST(ts AS BIGINT)*1000000) AS event_time, uid, src_ip, src_port,
  dest_ip, dest_port, proto, service, duration, orig_bytes, resp_bytes, conn_state FROM flows""",
    ),
)


def _with_gaps(flows):
    """Flows in which fields are missing as sensors leave them out."""
    return flows.withColumns(
        {
            "src_ip": F.when(F.col("conn_state") == "OTH", "-").when(F.col("conn_state") == "RSTO", "").otherwise(F.col("src_ip")),
            "dest_port": F.when(F.col("service").isNotNull(), F.col("dest_port")),
            "duration": F.when(F.col("proto") != "icmp", F.col("duration")),
            "orig_bytes": F.when(F.col("proto") != "udp", F.col("orig_bytes")),
        }
    )


_GAPS = """SELECT uid, dest_ip, resp_bytes, proto,
  CASE conn_state WHEN 'OTH' THEN '-' WHEN 'RSTO' THEN '' ELSE src_ip END AS src_ip,
  CASE WHEN service IS NOT NULL THEN dest_port END AS dest_port,
  CASE WHEN proto <> 'icmp' THEN duration END AS duration,
  CASE WHEN proto <> 'udp' THEN orig_bytes END AS orig_bytes FROM flows"""

register(
    "p15_valid_flows",
    lambda s, d: W.valid_flows(_with_gaps(views.flows(s, d))).groupBy("src_ip").agg(F.count("*").alias("n")),
    with_tables(
        "flows",
        select="""SELECT src_ip, count(*) AS n FROM gaps
WHERE src_ip IS NOT NULL AND dest_ip IS NOT NULL AND dest_port IS NOT NULL AND src_ip NOT IN ('', '-') GROUP BY src_ip""",
        extra={"gaps": _GAPS},
    ),
)
register(
    "p16_fill_missing",
    lambda s, d: P.fill_missing(_with_gaps(views.flows(s, d))).select("uid", "duration", "orig_bytes", "resp_bytes"),
    with_tables(
        "flows",
        select="""SELECT uid, coalesce(duration, 0.0) AS duration, coalesce(orig_bytes, 0) AS orig_bytes,
  coalesce(resp_bytes, 0) AS resp_bytes FROM gaps""",
        extra={"gaps": _GAPS},
    ),
)
register(
    "p17_log_features",
    lambda s, d: P.flow_features(views.flows(s, d)).select(
        *KEY, *[rounded(F.col(f), 6).alias(f) for f in P.FEATURES[:3]]
    ),
    with_tables(
        "featured",
        select=f"""SELECT {KEYS}, {rnd('a', 6)} AS duration_log, {rnd('b', 6)} AS orig_bytes_log,
  {rnd('c', 6)} AS resp_bytes_log FROM featured""",
    ),
)
register(
    "p18_is_dst_external",
    lambda s, d: P.flow_features(views.flows(s, d)).select("dest_ip", "is_dst_external"),
    with_tables("featured", select="SELECT dest_ip, is_dst_external FROM featured"),
)
register(
    "p19_is_src_server",
    lambda s, d: P.flow_features(views.flows(s, d)).select("src_ip", "is_src_server"),
    with_tables("featured", select="SELECT src_ip, is_src_server FROM featured"),
)
register(
    "p19_servers_from_table",
    lambda s, d: P.flag_servers(
        views.flows(s, d), views.indicators(s, d).select(F.col("indicator").alias("src_ip"))
    ).groupBy("src_ip", "is_src_server").agg(F.count("*").alias("n")),
    with_tables(
        "flows", "indicators",
        select="""SELECT src_ip, CASE WHEN src_ip IN (SELECT indicator FROM indicators) THEN 1 ELSE 0 END AS is_src_server,
  count(*) AS n FROM flows GROUP BY ALL""",
    ),
)
FLOW_COLUMNS = (
    "kafka_ts, ingest_ts, ts, uid, src_ip, src_port, dest_ip, dest_port, proto, service, duration, orig_bytes, "
    "resp_bytes, conn_state, is_dst_external, is_src_server, cluster_id, is_anomaly, ingest_date"
)
register(
    "p20_scored_flow_projection",
    lambda s, d: W.to_network_flows(views.scored_flows(s, d)).drop("anomaly_score"),
    with_tables("network_flows", select=f"SELECT {FLOW_COLUMNS} FROM network_flows"),
)
register(
    "p21_typed_flow_parse",
    lambda s, d: W.parse_flows_typed(prepared.flow_json(_with_gaps(views.flows(s, d)))),
    with_tables(
        "flows",
        select="""SELECT g.duration, g.orig_bytes, g.resp_bytes, g.src_ip, g.dest_ip, g.dest_port, g.proto, g.conn_state
FROM gaps g WHERE g.dest_port IS NOT NULL AND g.duration IS NOT NULL AND g.orig_bytes IS NOT NULL""",
        extra={"gaps": _GAPS.replace("SELECT uid,", "SELECT uid, conn_state,")},
    ),
)

# -- scaling and scoring ------------------------------------------------------

register(
    "m01_assembled_features",
    lambda s, d: P.complete_rows(P.flow_features(_with_gaps(views.flows(s, d))))
    .groupBy("proto")
    .agg(F.count("*").alias("n"), *[rounded(F.avg(f), 6).alias(f) for f in P.FEATURES]),
    with_tables(
        "flows",
        select=f"""SELECT proto, count(*) AS n, {rnd('avg(ln(1+coalesce(duration,0)))', 6)} AS duration_log,
  {rnd('avg(ln(1+coalesce(orig_bytes,0)))', 6)} AS orig_bytes_log, {rnd('avg(ln(1+resp_bytes))', 6)} AS resp_bytes_log,
  {rnd("avg(CASE WHEN dest_ip LIKE '172.16.%' THEN 0 ELSE 1 END)", 6)} AS is_dst_external,
  {rnd("avg(CASE WHEN src_ip = '192.168.1.250' THEN 1 ELSE 0 END)", 6)} AS is_src_server FROM gaps GROUP BY proto""",
        extra={"gaps": _GAPS},
    ),
)
register(
    "m02_scaled_features",
    lambda s, d: P.scale_features(P.flow_features(views.flows(s, d))).select(
        *KEY, *[rounded(F.col(z), 4).alias(z) for z in POINTS]
    ),
    with_tables(
        "scaled",
        select=f"SELECT {KEYS}, " + ", ".join(f"{rnd(v, 4)} AS {z}" for v, z in zip(("za", "zb", "zc", "zd", "ze"), POINTS))
        + " FROM scaled",
    ),
)
register(
    "m04_nearest_center",
    lambda s, d: views.scored_flows(s, d).select(*KEY, "cluster_id"),
    with_tables("network_flows", select=f"SELECT {KEYS}, cluster_id FROM network_flows"),
)
register(
    "m05_anomaly_score",
    lambda s, d: views.scored_flows(s, d).select(*KEY, rounded(F.col("anomaly_score"), 4).alias("score")),
    with_tables("network_flows", select=f"SELECT {KEYS}, {rnd('anomaly_score', 4)} AS score FROM network_flows"),
)
register(
    "m06_anomaly_flag",
    lambda s, d: views.scored_flows(s, d).groupBy("is_anomaly").agg(F.count("*").alias("n")),
    with_tables("network_flows", select="SELECT is_anomaly, count(*) AS n FROM network_flows GROUP BY is_anomaly"),
)


def trained_model(spark, sf_dir):
    return M.train(P.flow_features(views.flows(spark, sf_dir)))


def fit_report(model, flows):
    """Rows of the fit and of the flows, clusters, whether every flow is at its nearest center,
    and whether the cost of the fit is the sum of the squared distances. Spark takes the cost
    before the last move of the centers, which can only lower it, and by little."""
    scored = M.score(flows, model)
    squares = [
        reduce(add, [(z - F.lit(c)) ** 2 for z, c in zip(model.scaled(), center)]) for center in model.centers
    ]
    least = F.least(*squares)
    return scored.agg(
        F.lit(model.training_rows).cast("bigint").alias("training_rows"),
        F.count("*").alias("scored_rows"),
        F.lit(len(model.centers)).alias("clusters"),
        F.bool_and(F.abs(F.col("anomaly_score") - F.sqrt(least)) <= 1e-4 * (1 + F.sqrt(least))).alias("at_nearest"),
        (F.sum(least) / F.lit(model.wssse)).between(0.99, 1 + 1e-6).alias("cost_agrees"),
    )


def fitted_clusters(spark, sf_dir):
    flows = P.flow_features(views.flows(spark, sf_dir))
    return fit_report(M.train(flows), flows)


_FIT = with_tables(
    "flows",
    select="SELECT count(*) AS training_rows, count(*) AS scored_rows, 8 AS clusters, true AS at_nearest, true AS cost_agrees FROM flows",
)
_BASELINE_FIT = with_tables(
    "flows",
    select="""SELECT count(*) AS training_rows, count(*) AS scored_rows, 8 AS clusters, true AS at_nearest, true AS cost_agrees
FROM flows WHERE dest_port IS NOT NULL AND duration IS NOT NULL AND orig_bytes IS NOT NULL AND resp_bytes IS NOT NULL""",
)


register("m03_kmeans_fit", fitted_clusters, _FIT)
register(
    "m09_training_metrics",
    lambda s, d: M.metrics_row(s, trained_model(s, d), as_of(), 0).select(
        "training_id", "batch_id", "training_rows", (F.col("wssse") > 0).alias("has_cost"),
        (F.col("training_duration_sec") > 0).alias("has_duration"),
    ),
    with_tables(
        "flows",
        select="""SELECT CAST(1 AS BIGINT) AS training_id, CAST(0 AS BIGINT) AS batch_id, count(*) AS training_rows,
  true AS has_cost, true AS has_duration FROM flows""",
    ),
)


def baseline_clusters(spark, sf_dir):
    """The notebook baseline: raw features of all complete flows."""
    flows = M.baseline_rows(views.flows(spark, sf_dir))
    return fit_report(M.train(flows, P.RAW_FEATURES), flows)


register("m10_notebook_baseline", baseline_clusters, _BASELINE_FIT)
register(
    "o3_baseline_sample",
    lambda s, d: M.baseline_sample(
        views.flows(s, d), ["uid", "dest_ip", "dest_port", "orig_bytes", "resp_bytes"], 10_000
    ).select(*KEY),
    with_tables(
        "flows",
        select=f"SELECT {KEYS} FROM flows ORDER BY uid, dest_ip, dest_port, orig_bytes, resp_bytes LIMIT 10000",
    ),
)


def decayed_centers(spark, sf_dir):
    scaled = P.scale_features(P.flow_features(views.flows(spark, sf_dir)))
    moved = M.update_with_decay(
        scaled, [F.col(z) for z in POINTS], views.CENTERS, [100.0] * len(views.CENTERS), decay=0.9
    )
    return moved.select(
        "cluster_id", "weight", *[rounded(F.col("center")[i], 4).alias(f"c{i}") for i in range(len(POINTS))]
    )


_CENTER_SQL = "\n  UNION ALL ".join(
    "SELECT " + f"{n} AS id, " + ", ".join(f"{x} AS o{i}" for i, x in enumerate(c))
    for n, c in enumerate(views.CENTERS)
)
register(
    "m12_decayed_centers",
    decayed_centers,
    with_tables(
        "network_flows",
        select="SELECT CAST(id AS INT) AS cluster_id, CAST(100.0*0.9 + coalesce(m, 0) AS DOUBLE) AS weight, "
        + ", ".join(
            rnd(f"(o{i}*100.0*0.9 + coalesce(s{i}, 0)) / (100.0*0.9 + coalesce(m, 0))", 4) + f" AS c{i}" for i in range(5)
        )
        + " FROM centers LEFT JOIN sums ON id = cluster_id",
        extra={
            "centers": _CENTER_SQL,
            "sums": "SELECT cluster_id, count(*) AS m, sum(za) AS s0, sum(zb) AS s1, sum(zc) AS s2, sum(zd) AS s3, "
            "sum(ze) AS s4 FROM network_flows GROUP BY cluster_id",
        },
    ),
)
_LABELLED = {
    "labelled": """SELECT *, kind IS NOT NULL AS is_attack FROM (SELECT *, CASE WHEN orig_bytes >= 9000000 THEN 'EXFIL'
  WHEN conn_state = 'REJ' AND duration < 1 THEN 'SCAN' WHEN conn_state = 'S0' AND is_dst_external = 0 THEN 'DDOS' END AS kind
  FROM network_flows)"""
}
register(
    "m13_confusion",
    lambda s, d: M.confusion(views.labelled_flows(s, d)),
    with_tables(
        "network_flows",
        select=f"""SELECT tp, fp, fn, tn, {rnd('tp / (tp + fp)', 4)} AS "precision", {rnd('tp / (tp + fn)', 4)} AS recall FROM (
  SELECT count(*) FILTER (WHERE is_attack AND is_anomaly) AS tp, count(*) FILTER (WHERE NOT is_attack AND is_anomaly) AS fp,
    count(*) FILTER (WHERE is_attack AND NOT is_anomaly) AS fn, count(*) FILTER (WHERE NOT is_attack AND NOT is_anomaly) AS tn
  FROM labelled)""",
        extra=_LABELLED,
    ),
)
register(
    "m13_recall_by_kind",
    lambda s, d: M.recall_by_kind(views.labelled_flows(s, d)),
    with_tables(
        "network_flows",
        select=f"""SELECT kind AS attack_kind, count(*) AS flows, count(*) FILTER (WHERE is_anomaly) AS detected,
  {rnd('count(*) FILTER (WHERE is_anomaly) / count(*)', 4)} AS recall FROM labelled WHERE is_attack GROUP BY kind""",
        extra=_LABELLED,
    ),
)

# -- forensic queries ---------------------------------------------------------


def _anomalies(fn, *args):
    return lambda s, d: fn(prepared.network_anomalies(s, d), *[a() if callable(a) else a for a in args])


def _flows(fn, *args):
    return lambda s, d: fn(prepared.network_flows(s, d), *[a() if callable(a) else a for a in args])


AVG = f"{rnd('avg(anomaly_score)', 3)} AS avg_score"
MAX = f"{rnd('max(anomaly_score)', 3)} AS max_score"


def _sql(select, table="network_anomalies", **kw):
    return with_tables(table, select=select, **kw)


register(
    "q01_recent_anomalies", _anomalies(X.recent_anomalies, as_of, "1 HOUR"),
    _sql(f"""SELECT ingest_ts, src_ip, dest_ip, dest_port, proto, {rnd('duration', 2)} AS duration_sec, orig_bytes,
  resp_bytes, {rnd('anomaly_score', 3)} AS score, cluster_id, conn_state FROM network_anomalies
WHERE ingest_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR
ORDER BY anomaly_score DESC, ingest_ts, src_ip, dest_ip, dest_port, orig_bytes, resp_bytes, uid LIMIT 100"""),
)
register(
    "q02_top_sources", _anomalies(X.top_sources),
    _sql(f"""SELECT src_ip, count(*) AS anomaly_count, {AVG}, {MAX}, count(DISTINCT dest_port) AS unique_dest_ports
FROM network_anomalies GROUP BY src_ip ORDER BY anomaly_count DESC, src_ip LIMIT 20"""),
)
register(
    "q03_density_per_minute", _anomalies(X.density_per_minute, as_of, "6 HOURS"),
    _sql(f"""SELECT strftime(ingest_ts, '%Y-%m-%d %H:%M') AS minute_bucket, count(*) AS anomaly_count, {AVG}, {MAX}
FROM network_anomalies WHERE ingest_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR GROUP BY 1"""),
)
register(
    "q04_port_scanners", _anomalies(X.port_scanners),
    _sql(f"""SELECT src_ip, count(DISTINCT dest_port) AS unique_ports_hit, count(*) AS total_flows,
  {rnd('avg(duration)', 4)} AS avg_duration, {rnd('avg(orig_bytes)', 0)} AS avg_orig_bytes FROM network_anomalies
WHERE conn_state IN ('REJ','S0','RSTOS0') GROUP BY src_ip HAVING count(DISTINCT dest_port) > 20"""),
)
register(
    "q05_large_transfers", _anomalies(X.large_transfers),
    _sql(f"""SELECT src_ip, dest_ip, dest_port, proto, {rnd('duration', 0)} AS duration_sec, orig_bytes, resp_bytes,
  {rnd('anomaly_score', 3)} AS score FROM network_anomalies WHERE orig_bytes > 1000000
ORDER BY orig_bytes DESC, src_ip, dest_ip, dest_port, proto, duration, resp_bytes, anomaly_score, uid LIMIT 50"""),
)
register(
    "q06_by_protocol", _anomalies(X.by_protocol),
    _sql(f"SELECT proto, count(*) AS anomaly_count, {AVG} FROM network_anomalies GROUP BY proto"),
)
register(
    "q07_cluster_statistics", _anomalies(X.cluster_statistics),
    _sql(f"""SELECT cluster_id, count(*) AS anomaly_count, {AVG}, {rnd('min(anomaly_score)', 3)} AS min_score, {MAX}
FROM network_anomalies GROUP BY cluster_id"""),
)
register(
    "q08_anomaly_share", _flows(X.anomaly_share, as_of, "1 HOUR"),
    _sql(
        f"""SELECT is_anomaly, n AS flow_count, {rnd('n*100.0/sum(n) OVER ()', 2)} AS pct FROM (
  SELECT is_anomaly, count(*) AS n FROM network_flows
  WHERE ingest_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR GROUP BY is_anomaly)""",
        "network_flows",
    ),
)
register(
    "q09_by_port", _anomalies(X.by_port),
    _sql(f"""SELECT dest_port, proto, count(*) AS anomaly_count, {AVG} FROM network_anomalies
GROUP BY dest_port, proto ORDER BY anomaly_count DESC, dest_port, proto LIMIT 30"""),
)
register(
    "q10_daily_summary", _anomalies(X.daily_summary),
    _sql(f"""SELECT ingest_date, count(*) AS total_anomalies, count(DISTINCT src_ip) AS unique_src_ips,
  count(DISTINCT dest_ip) AS unique_dest_ips, {AVG}, {MAX} FROM network_anomalies GROUP BY ingest_date"""),
)
register("q33_anomaly_count", _anomalies(D.anomaly_count), _sql('SELECT count(*) AS "count" FROM network_anomalies'))
register(
    "q34_average_score", _anomalies(D.average_score),
    _sql(f"SELECT {rnd('avg(anomaly_score)', 4)} AS avg_anomaly_score FROM network_anomalies"),
)
register(
    "q37_anomaly_timeline", _anomalies(D.anomaly_timeline),
    _sql("""SELECT date_trunc('minute', ingest_ts) AS bucket, count(*) AS "count" FROM network_anomalies GROUP BY 1"""),
)
register(
    "q42_anomalies_by_service", _anomalies(D.anomalies_by_service),
    _sql('SELECT service, count(*) AS "count" FROM network_anomalies GROUP BY service'),
)
register(
    "q43_anomalies_by_source", _anomalies(D.anomalies_by_source),
    _sql('SELECT src_ip, count(*) AS "count" FROM network_anomalies GROUP BY src_ip'),
)
register(
    "q45_anomaly_feed",
    lambda s, d: D.anomaly_feed(prepared.network_anomalies(s, d)).withColumn(
        "anomaly_score", rounded(F.col("anomaly_score"), 4)
    ),
    _sql(f"""SELECT ingest_ts, src_ip, src_port, dest_ip, dest_port, proto, service,
  {rnd('anomaly_score', 4)} AS anomaly_score FROM network_anomalies"""),
)
register(
    "q46_pruned_lookup", _flows(X.pruned_lookup, "2024-01-10", 22),
    _sql(
        """SELECT ingest_ts, src_ip, dest_ip, dest_port, orig_bytes, conn_state FROM network_flows
WHERE ingest_date = DATE '2024-01-10' AND dest_port = 22""",
        "network_flows",
    ),
)
register(
    "q46_count_between", _flows(X.count_between, 22, "2024-01-10 00:00:00", "2024-01-12 12:00:00"),
    _sql(
        """SELECT count(*) AS flow_count FROM network_flows WHERE dest_port = 22
AND ingest_ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
        "network_flows",
    ),
)
register(
    "w1_share_by_state",
    _flows(lambda f: X.with_share(f.groupBy("conn_state").agg(F.count("*").alias("n")), "n")),
    _sql(
        f"""SELECT conn_state, n, {rnd('n*100.0/sum(n) OVER ()', 2)} AS pct
FROM (SELECT conn_state, count(*) AS n FROM network_flows GROUP BY conn_state)""",
        "network_flows",
    ),
)

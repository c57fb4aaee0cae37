"""Indicator joins, address ranges, behavioural hunts and table upkeep."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import prepared, views
from checks.log_queries import TODAY
from checks.registry import ORACLES, register
from checks.sql import rnd, with_tables
from loghaven.functions.net import ipv4_number
from loghaven.lake import new_folder, stored
from loghaven.operators import hunting as H
from loghaven.operators import intel as I
from loghaven.operators import maintenance as U
from loghaven.operators import netrange as N
from loghaven.operators import sketches as S
from loghaven.streaming.beacons import BeaconState

SRC = ["src_ip", "dest_ip", "dest_port", "orig_bytes"]


def by_source(spark, sf_dir):
    """Listed addresses under the flows' column name."""
    return views.indicators(spark, sf_dir).withColumnRenamed("indicator", "src_ip")


def _flows(spark, sf_dir):
    return prepared.network_flows(spark, sf_dir)


_MATCHED = with_tables(
    "flows", "indicators",
    select=f"SELECT {', '.join(SRC)} FROM flows WHERE src_ip IN (SELECT indicator FROM indicators)",
)
register(
    "j2_indicator_match",
    lambda s, d: I.match_indicators(_flows(s, d), by_source(s, d), "src_ip").select(*SRC),
    _MATCHED,
)
register(
    "j2_indicator_match_beyond_bound",
    lambda s, d: I.match_indicators(_flows(s, d), by_source(s, d), "src_ip", max_rows=0).select(*SRC),
    _MATCHED,
)
register(
    "j3_bloom_filtered_match",
    lambda s, d: I.match_indicators_shuffled(_flows(s, d), by_source(s, d), "src_ip").select(*SRC),
    _MATCHED,
)


def hot_match(spark, sf_dir):
    """Flows of which one source holds far more than a task's share, by a shuffled join."""
    return I.hot_key_join(_flows(spark, sf_dir), by_source(spark, sf_dir).distinct(), "src_ip", "left", parts=64).groupBy("src_ip", "origin").agg(
        F.count("*").alias("n")
    )


register(
    "j6_hot_keys_by_sketch",
    hot_match,
    with_tables(
        "flows", "indicators",
        select="SELECT src_ip, origin, count(*) AS n FROM flows LEFT JOIN (SELECT DISTINCT indicator AS src_ip, origin FROM indicators) USING (src_ip) GROUP BY ALL",
    ),
)


def hot_sources(spark, sf_dir):
    """The sources that a sketch finds above a 64th of all flows, with their exact numbers."""
    flows = _flows(spark, sf_dir)
    found = list(I.hot_keys(flows, "src_ip", 64))
    return flows.where(F.col("src_ip").isin(found)).groupBy("src_ip").agg(F.count("*").alias("n"))


register(
    "j6_hot_keys",
    hot_sources,
    with_tables("flows", select="SELECT src_ip, count(*) AS n FROM flows GROUP BY src_ip HAVING count(*) > (SELECT count(*) FROM flows) // 64"),
)
register(
    "j3_bitmap_prefiltered_match",
    lambda s, d: I.match_indicators_prefiltered(_flows(s, d), by_source(s, d), "src_ip")[0].select(*SRC),
    _MATCHED,
)


def let_through(spark, sf_dir):
    """Destinations and ports as keys, one in seven listed: matches, and whether the filter loses
    none and lets under 2 % of the others through."""
    flows = _flows(spark, sf_dir).withColumn("key", F.concat_ws(":", "dest_ip", "dest_port", "orig_bytes"))
    listed = flows.where(F.col("orig_bytes") % 7 == 0).select("key")
    matched, through = I.match_indicators_prefiltered(flows, listed, "key")
    counts = stored(through.withColumn("hit", F.col("orig_bytes") % 7 == 0), "through").agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("others")
    )
    n, wanted = flows.count(), matched.count()
    return counts.select(F.lit(wanted).cast("long").alias("matched"), "hits", (F.col("others") <= 0.02 * (n - wanted)).alias("few_others"))


register(
    "j3_bitmap_false_positives",
    let_through,
    with_tables("flows", select="SELECT count(*) AS matched, count(*) AS hits, true AS few_others FROM flows WHERE orig_bytes % 7 = 0"),
)


def bucketed(spark, sf_dir):
    """Flows joined with assets through two tables bucketed by address and salt."""
    name = f"{spark.sparkContext.applicationId}_{abs(hash(sf_dir))}".replace("-", "_")
    flows, assets = f"flows_{name}", f"assets_{name}"

    def write(folder):
        I.write_bucketed(_flows(spark, sf_dir).select(*SRC), flows, "src_ip", 8, 4, path=f"{folder}/flows")
        listed = I.unique_by_key(by_source(spark, sf_dir), "src_ip")
        I.write_bucketed(listed, assets, "src_ip", 8, 4, replicated=True, path=f"{folder}/assets")

    prepared.written(spark, sf_dir, "bucketed", write)
    return I.join_bucketed(spark.table(flows), spark.table(assets), "src_ip")


_TAGGED = "SELECT indicator AS src_ip, min(origin) AS origin FROM indicators GROUP BY indicator"
register(
    "j5_bucketed_join",
    bucketed,
    with_tables(
        "flows", "indicators",
        select=f"SELECT {', '.join(SRC)}, origin FROM flows JOIN tags USING (src_ip)", extra={"tags": _TAGGED},
    ),
)
register(
    "j6_map_side_tagging",
    lambda s, d: I.tag_indicators(_flows(s, d), by_source(s, d), "src_ip")
    .groupBy("src_ip", "origin").agg(F.count("*").alias("n")),
    with_tables(
        "flows", "indicators",
        select="SELECT src_ip, origin, count(*) AS n FROM flows LEFT JOIN tags USING (src_ip) GROUP BY ALL",
        extra={"tags": _TAGGED},
    ),
)


def _sightings(max_rows):
    def run(spark, sf_dir):
        logs, flows = prepared.logs_parsed(spark, sf_dir), _flows(spark, sf_dir)
        listed = views.indicators(spark, sf_dir).select("indicator").unionByName(
            logs.filter(F.col("intelligence_tag") == "Tor Exit Node").select(F.col("client_ip").alias("indicator"))
        )
        history = [
            ("logs", logs, "client_ip", "ingest_ts"),
            ("flow sources", flows, "src_ip", "ingest_ts"),
            ("flow destinations", flows, "dest_ip", "ingest_ts"),
        ]
        return I.sightings(history, listed, max_rows=max_rows)

    return run


_SIGHTINGS = with_tables(
    "logs_parsed", "flows", "indicators",
    select="""SELECT indicator, source, min(seen_at) AS first_seen, max(seen_at) AS last_seen, count(*) AS sightings FROM (
  SELECT client_ip AS indicator, 'logs' AS source, ingest_ts AS seen_at FROM logs_parsed
  UNION ALL SELECT src_ip, 'flow sources', kafka_ts FROM flows
  UNION ALL SELECT dest_ip, 'flow destinations', kafka_ts FROM flows)
WHERE indicator IN (SELECT indicator FROM indicators UNION SELECT client_ip FROM logs_parsed
  WHERE intelligence_tag = 'Tor Exit Node') GROUP BY indicator, source""",
)
register("j7_retroactive_hunt", _sightings(I.BROADCAST_ROWS), _SIGHTINGS)
register("j7_retroactive_hunt_beyond_bound", _sightings(0), _SIGHTINGS)


def _ranges(spark, sf_dir):
    """The disjoint ranges, stored: they are counted before they are joined."""
    return stored(N.disjoint_ranges(views.address_ranges(spark, sf_dir), "area"), "ranges")


def _area(max_rows):
    def run(spark, sf_dir):
        located = N.locate(_flows(spark, sf_dir), "src_ip", _ranges(spark, sf_dir), "area", "src_area", max_rows)
        return located.groupBy("src_ip", "src_area").agg(F.count("*").alias("n"))

    return run


_AREAS = with_tables(
    "places",
    select="""SELECT src_ip, area AS src_area, count(*) AS n FROM flows LEFT JOIN places ON src_ip = ip GROUP BY ALL""",
)
register("p24_address_areas", _area(N.MAX_BROADCAST_RANGES), _AREAS)
register("p24_address_areas_beyond_bound", _area(0), _AREAS)
register(
    "p24_flow_map",
    lambda s, d: N.flow_map(_flows(s, d), _ranges(s, d), "area"),
    with_tables(
        "places",
        select="""SELECT a.area AS src_area, b.area AS dest_area, count(*) AS flows, CAST(sum(orig_bytes) AS BIGINT) AS bytes,
  count(DISTINCT src_ip) AS sources FROM flows LEFT JOIN places a ON src_ip = a.ip LEFT JOIN places b ON dest_ip = b.ip
GROUP BY ALL""",
    ),
)

# -- behaviour ----------------------------------------------------------------


def _events(spark, sf_dir):
    return views.table(spark, sf_dir, "events")


register(
    "w3_event_sequence",
    lambda s, d: H.followed_by(
        _events(s, d), "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", 86_400
    ).select("user_id", "first_at", "then_at"),
    """SELECT a.user_id, a.ts AS first_at, min(b.ts) AS then_at FROM
  (SELECT *, row_number() OVER () AS id FROM events WHERE event_type = 'signup') a
JOIN events b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 DAY
GROUP BY a.id, a.user_id, a.ts""",
)
register(
    "w4_beacons",
    lambda s, d: H.beacons(
        _events(s, d), "ts", ("user_id", "event_type"), min_events=3, max_variation=0.8, max_bytes=None
    ),
    f"""WITH g AS (SELECT user_id, event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts)
  AS gap FROM events),
  s AS (SELECT user_id, event_type, count(gap) AS gaps, avg(gap/1e6) AS mean_gap, stddev_samp(gap/1e6) AS std_gap FROM g
  WHERE gap IS NOT NULL GROUP BY user_id, event_type)
SELECT user_id, event_type, gaps + 1 AS events, {rnd('mean_gap', 3)} AS mean_gap_sec, {rnd('std_gap/mean_gap', 4)} AS variation
FROM s WHERE gaps >= 2 AND mean_gap > 0 AND std_gap/mean_gap < 0.8""",
)
register(
    "w4_beacons_of_flows",
    lambda s, d: H.beacons(
        _flows(s, d), "ingest_ts", ("src_ip", "proto"), min_events=20, max_variation=1.5, max_bytes=5_000_000
    ),
    with_tables(
        "flows",
        select=f"""SELECT src_ip, proto, gaps + 1 AS events, {rnd('mean_gap', 3)} AS mean_gap_sec,
  {rnd('std_gap/mean_gap', 4)} AS variation
FROM s JOIN (SELECT src_ip, proto FROM flows GROUP BY ALL HAVING avg(orig_bytes) <= 5000000) USING (src_ip, proto)
WHERE gaps >= 19 AND mean_gap > 0 AND std_gap/mean_gap < 1.5""",
        extra={
            "g": """SELECT src_ip, proto, epoch_us(kafka_ts) - lag(epoch_us(kafka_ts)) OVER (PARTITION BY src_ip, proto
  ORDER BY kafka_ts) AS gap FROM flows""",
            "s": """SELECT src_ip, proto, count(gap) AS gaps, avg(gap/1e6) AS mean_gap, stddev_samp(gap/1e6) AS std_gap
  FROM g WHERE gap IS NOT NULL GROUP BY src_ip, proto""",
        },
    ),
)
def beacons_by_batch(spark, sf_dir):
    """The beacons of flows from three batches, a third of the month each, that are merged."""
    state = BeaconState(new_folder(spark, "beacons"), ("src_ip", "proto"), "ingest_ts")
    for third in range(3):
        part = F.least(F.floor((F.dayofmonth("ingest_ts") - 1) / 10), F.lit(2)) == third
        state.process(_flows(spark, sf_dir).where(part), third)
    return state.beacons(spark, min_events=20, max_variation=1.5, max_bytes=5_000_000)


register("w4_beacons_by_batch", beacons_by_batch, ORACLES["w4_beacons_of_flows"])


def _sketched(spark, sf_dir):
    """Sketches of the destination ports of each source and day, written in two batches."""

    def write(folder):
        flows = _flows(spark, sf_dir).withColumn("port", F.concat_ws(":", "dest_ip", "dest_port"))
        table = S.SketchTable(folder, "ingest_ts", ("src_ip",), "port")
        for batch in range(2):
            table.add(flows.where(F.pmod(F.xxhash64("uid"), F.lit(2)) == batch), batch)

    return S.SketchTable(prepared.written(spark, sf_dir, "port_sketches", write), "ingest_ts", ("src_ip",), "port")


def sketched_ports(keys, start, end):
    """Estimates over some days of the stored sketches, and whether they are as near the exact
    numbers as stated."""

    def run(spark, sf_dir):
        found = _sketched(spark, sf_dir).estimate(spark, keys, start, end)
        flows = _flows(spark, sf_dir).where(F.col("ingest_date").between(start, end))
        exact = flows.groupBy(*keys).agg(F.count_distinct(F.concat_ws(":", "dest_ip", "dest_port")).alias("exact"))
        one = F.lit(1).alias("one")  # so that sketches merged over all sources join too
        both = found.select("*", one).join(exact.select("*", one), [*keys, "one"])
        near = F.abs(F.col("distinct") - F.col("exact")) <= F.lit(S.ERROR) * F.col("exact")
        return both.select(*keys, "n", "exact", near.alias("within_error"))

    return run


register(
    "d8_ports_by_sketch",
    sketched_ports(("src_ip",), "2024-01-05", "2024-01-20"),
    with_tables(
        "flows",
        select="""SELECT src_ip, count(*) AS n, count(DISTINCT concat(dest_ip, ':', dest_port)) AS exact, true AS within_error FROM flows
WHERE CAST(kafka_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY src_ip""",
    ),
)
register(
    "q10_ports_by_sketch",
    sketched_ports((), "2024-01-01", "2024-01-31"),
    with_tables("flows", select="SELECT count(*) AS n, count(DISTINCT concat(dest_ip, ':', dest_port)) AS exact, true AS within_error FROM flows"),
)
register(
    "w5_floods",
    lambda s, d: H.floods(_flows(s, d), "ingest_ts", "1 day", 5),
    with_tables(
        "flows",
        select="""SELECT date_trunc('day', kafka_ts) AS window_start, dest_ip, count(DISTINCT src_ip) AS sources, count(*) AS flows
FROM flows GROUP BY ALL HAVING count(DISTINCT src_ip) > 5""",
    ),
)
register(
    "t05_tumbling_counts",
    lambda s, d: H.tumbling_counts(_events(s, d), "ts", ["user_id"]),
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
  AS window_end, user_id, count(*) AS n FROM events GROUP BY ALL""",
)
register(
    "t06_sliding_failed_logins",
    lambda s, d: H.sliding_counts(
        prepared.logs_parsed(s, d).filter(F.col("raw_log").like("%Failed password%")), "ingest_ts", ["syslog_host"]
    ),
    with_tables(
        "logs_parsed",
        select="""SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, syslog_host, count(*) AS n FROM (
  SELECT date_trunc('minute', ingest_ts) - to_minutes(unnest(range(5))) AS w, syslog_host FROM logs_parsed
  WHERE contains(raw_log, 'Failed password')) GROUP BY ALL""",
    ),
)
register(
    "t08_deduplicated",
    lambda s, d: H.deduplicate(_events(s, d).unionByName(_events(s, d)), ["event_id"]).select(
        "event_id", "user_id", "event_type"
    ),
    "SELECT event_id, user_id, event_type FROM events",
)
register(
    "j4_interval_join",
    lambda s, d: I.interval_join(
        _events(s, d).filter("event_type = 'signup'").select("user_id", F.col("ts").cast("timestamp").alias("signed_at")),
        _events(s, d).filter("event_type = 'purchase'").select("user_id", F.col("ts").cast("timestamp").alias("bought_at")),
        "user_id", "signed_at", "bought_at", "6 HOURS",
    ),
    """SELECT a.user_id, a.ts AS signed_at, b.ts AS bought_at FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'signup' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 6 HOUR""",
)

# -- upkeep -------------------------------------------------------------------

def sorted_files(spark, sf_dir):
    """Totals of the sorted table's eight files, and how many begin before the one before ends. Of a
    large table each is a run of parts, one for each writer, and the parts are compared."""
    folder = new_folder(spark, "sorted")
    parts = prepared.record_parts(views.table(spark, sf_dir, "lineitem"), 8)
    U.sorted_for_pruning(_flows(spark, sf_dir), ("ingest_ts", "src_ip"), 8 * parts).write.parquet(folder)
    part = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("int")
    files = spark.read.parquet(folder).groupBy(part.alias("part")).agg(
        F.min("ingest_ts").alias("least"), F.max("ingest_ts").alias("most"), F.count("*").alias("n"),
        F.sum("orig_bytes").alias("bytes"),
    )
    before = F.max("most").over(Window.orderBy("least", "most").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("before", before).agg(
        F.count_distinct(F.floor(F.col("part") / parts)).alias("files"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.count_if(F.col("least") < F.col("before")).alias("overlapping"),
    )


register(
    "x2_sorted_for_pruning",
    sorted_files,
    with_tables(
        "network_flows",
        select="""SELECT CAST(8 AS BIGINT) AS files, count(*) AS n, CAST(sum(orig_bytes) AS BIGINT) AS bytes,
  CAST(0 AS BIGINT) AS overlapping FROM network_flows""",
    ),
)


def files_touched(rows, folder, time, low, high, address):
    """n, bytes and of how many files the bounds meet a span of time, and an address."""
    rows.write.parquet(folder)
    number = ipv4_number(F.col("src_ip"))
    files = rows.sparkSession.read.parquet(folder).groupBy(F.input_file_name().alias("file")).agg(
        F.min(time).alias("t0"), F.max(time).alias("t1"), F.min(number).alias("a0"), F.max(number).alias("a1"),
        F.count("*").alias("n"), F.sum("orig_bytes").alias("bytes"),
    )
    at = ipv4_number(F.lit(address))
    return files.agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.count_if((F.col("t0") <= F.lit(high).cast("timestamp")) & (F.col("t1") >= F.lit(low).cast("timestamp"))).alias("of_time"),
        F.count_if((F.col("a0") <= at) & (F.col("a1") >= at)).alias("of_address"),
    )


def two_column_layout(spark, sf_dir):
    """One table in 64 files by time, and by time and address together: a day and an address each
    touch a part of the latter's files, and the address fewer than of the former's."""
    flows, folder = _flows(spark, sf_dir), new_folder(spark, "two-columns")
    asked = ("ingest_ts", "2024-01-10", "2024-01-11", "41.7.0.7")
    by_time = files_touched(U.sorted_for_pruning(flows, ["ingest_ts"], 64), f"{folder}/time", *asked)
    both = [F.col("ingest_ts").cast("double"), ipv4_number(F.col("src_ip"))]
    by_both = files_touched(U.sorted_by_all(flows, both, 64), f"{folder}/both", *asked)
    old = by_time.select(F.col("of_address").alias("before"), F.lit(1).alias("one"))
    return by_both.withColumn("one", F.lit(1)).join(old, "one").select(
        "n", "bytes", (F.col("of_time") <= 32).alias("time_prunes"), (F.col("of_address") <= 32).alias("address_prunes"),
        (F.col("of_address") * 2 <= F.col("before")).alias("fewer_than_by_time"),
    )


register(
    "x2_sorted_by_two_columns",
    two_column_layout,
    with_tables(
        "flows",
        select="SELECT count(*) AS n, CAST(sum(orig_bytes) AS BIGINT) AS bytes, true AS time_prunes, true AS address_prunes, true AS fewer_than_by_time FROM flows",
    ),
)


def dense_block(max_rows):
    """Sources located among 65,536 single addresses of one block, each an area of its own."""

    def run(spark, sf_dir):
        block = spark.range(1 << 16).select(
            F.concat_ws(".", F.lit("41.7"), F.floor(F.col("id") / 256).cast("string"), (F.col("id") % 256).cast("string")).alias("ip")
        )
        ranges = stored(N.disjoint_ranges(block.select(F.concat("ip", F.lit("/32")).alias("cidr"), F.concat(F.lit("host "), "ip").alias("area")), "area"), "dense")
        return N.locate(_flows(spark, sf_dir), "src_ip", ranges, "area", "src_area", max_rows).groupBy("src_ip", "src_area").agg(F.count("*").alias("n"))

    return run


_DENSE = with_tables("flows", select="SELECT src_ip, CASE WHEN src_ip LIKE '41.7.%' THEN concat('host ', src_ip) END AS src_area, count(*) AS n FROM flows GROUP BY ALL")
register("p24_dense_block", dense_block(N.MAX_BROADCAST_RANGES), _DENSE)
register("p24_dense_block_beyond_bound", dense_block(0), _DENSE)


def retained(spark, sf_dir):
    """Keep ten days of a partitioned table; then totals per remaining date."""
    folder = new_folder(spark, "retained")
    table = folder.rsplit("/", 1)[-1].replace("-", "_")
    _flows(spark, sf_dir).write.partitionBy("ingest_date").option("path", folder).saveAsTable(table)
    U.expire(spark, table, "ingest_date", 10, TODAY)
    return spark.table(table).groupBy("ingest_date").agg(
        F.count("*").alias("n"), F.sum("orig_bytes").alias("bytes")
    )


register(
    "x3_retention",
    retained,
    with_tables(
        "network_flows",
        select=f"""SELECT ingest_date, count(*) AS n, CAST(sum(orig_bytes) AS BIGINT) AS bytes FROM network_flows
WHERE ingest_date >= DATE '{TODAY}' - 10 GROUP BY ingest_date""",
    ),
)

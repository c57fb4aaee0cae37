"""Streams over the given tables, run to the end of their input; sinks and restarts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import prepared, views
from checks.log_queries import WINDOW_THRESHOLDS
from checks.registry import register
from checks.sql import DETECTED_AT, RULES, rnd, rule_select, with_tables
from loghaven.lake import FOLDS, Lake, folders, made, move, new_folder, partition_specs, scan, stored
from loghaven.functions.numeric import rounded
from loghaven.operators import anomaly as M
from loghaven.operators import features as P
from loghaven.operators import hunting as H
from loghaven.operators import maintenance as U
from loghaven.operators import rules as R
from loghaven.operators.features import RAW_FEATURES
from loghaven.operators.logs import parse_logs
from loghaven.plans import dashboards as D
from loghaven.sources import streams
from loghaven.streaming import etl, windows
from loghaven.streaming.detector import DecayingDetector, FlowDetector, NotebookDetector, flow_stream
from loghaven.streaming.hunts import IndicatorHunt
from loghaven.streaming.models import ModelStore

ALL = {"availableNow": True}


def event_stream(spark, sf_dir):
    return streams.read_table_stream(spark, sf_dir, "events.parquet")


def drained(rows, name):
    """Run an append-mode stream over the input at hand into files and read them."""
    spark = rows.sparkSession
    folder, checkpoint = new_folder(spark, name), new_folder(spark, "checkpoint")
    query = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", folder).trigger(**ALL).start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(folder)


# -- log stream ---------------------------------------------------------------


def etl_lake(spark, sf_dir):
    """A lake filled by the log job from record files, in one batch."""

    def write(folder):
        records = streams.read_record_files(spark, prepared.log_record_files(spark, sf_dir))
        etl.start_log_etl(records, Lake(location=folder), f"{folder}/checkpoint", trigger=ALL).awaitTermination()

    return Lake(location=prepared.written(spark, sf_dir, "etl_lake", write))


def etl_table(name):
    return lambda spark, sf_dir: etl_lake(spark, sf_dir).read(spark, name)


register(
    "s01_log_stream",
    lambda s, d: D.events_per_topic(etl_table("logs_parsed")(s, d)),
    with_tables(
        "raw_logs", select="SELECT source_topic, count(*) AS event_count FROM raw_logs GROUP BY source_topic"
    ),
)
register("k01_parsed_log_sink", etl_table("logs_parsed"), with_tables("logs_parsed", select="SELECT * FROM logs_parsed"))
register(
    "k02_alert_sink",
    lambda s, d: etl_table("alerts")(s, d).drop("detected_at", "detect_date"),
    with_tables("alerts", select="SELECT * EXCLUDE (detected_at, detect_date) FROM alerts"),
)


def rate_limited(spark, sf_dir):
    """The same stream, a quarter of the files per batch: alerts are per batch, logs are the same."""
    source = prepared.log_record_files(spark, sf_dir)
    at_once = prepared.files_per_batch(spark, source, prepared.LOG_BATCHES)
    records = streams.read_record_files(spark, source, max_files_per_trigger=at_once)
    lake = Lake(location=new_folder(spark, "limited_lake"))
    etl.start_log_etl(records, lake, f"{lake.location}/checkpoint", trigger=ALL).awaitTermination()
    by_path = spark.read.parquet(lake.path("logs_parsed"))
    batches = by_path.select("batch_id").distinct().count()
    return D.daily_volume(by_path).withColumn("batches", F.lit(batches))


register(
    "s03_rate_limited_stream",
    rate_limited,
    with_tables("logs_parsed", select="SELECT ingest_date, count(*) AS daily_total, 4 AS batches FROM logs_parsed GROUP BY 1"),
)


def landed_lake(spark, name, batches, rules=R.DEFAULT_RULES, sf_dir=None, registered=True):
    """A lake with catalog tables, filled by the log job's batches."""
    folder = new_folder(spark, name)
    lake = Lake(database="siem_" + folder.rsplit("-", 1)[-1], location=folder)
    if registered:
        lake.create_tables(spark)
    logs = parse_logs(views.raw_logs(spark, sf_dir)).withColumn("batch_ts", F.to_timestamp(F.lit(DETECTED_AT)))
    for b in range(batches):
        etl.land_batch(logs.filter(F.pmod(F.xxhash64("raw_log"), F.lit(batches)) == b), b, lake, rules)
    return lake


def scanned(spark, sf_dir):
    """The catalog's table after two batches of the log job."""
    lake = landed_lake(spark, "scanned", 2, sf_dir=sf_dir)
    return scan(spark, lake.name("logs_parsed")).drop("batch_id")


register("s11_table_scan", scanned, with_tables("logs_parsed", select="SELECT * FROM logs_parsed"))


def synced(spark, sf_dir):
    """Batches landed before the catalog's tables existed, made known afterwards."""
    lake = landed_lake(spark, "synced", 2, sf_dir=sf_dir, registered=False)
    lake.create_tables(spark)
    lake.sync(spark, "logs_parsed")
    return D.daily_volume(spark.table(lake.name("logs_parsed")))


register(
    "k07_partitions_synced",
    synced,
    with_tables("logs_parsed", select="SELECT ingest_date, count(*) AS daily_total FROM logs_parsed GROUP BY 1"),
)


def replayed_with_less(spark, sf_dir):
    """A batch replayed under thresholds that nothing exceeds: its alerts go, its logs stay."""
    lake = landed_lake(spark, "less", 1, sf_dir=sf_dir)
    logs = parse_logs(views.raw_logs(spark, sf_dir)).withColumn("batch_ts", F.to_timestamp(F.lit(DETECTED_AT)))
    before = lake.read(spark, "alerts").count()
    none = R.select_rules(thresholds={r.rule_id: 1 << 60 for r in R.DEFAULT_RULES})
    etl.land_batch(logs, 0, lake, none)
    parts = [
        lake.read(spark, t).agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in ("logs_parsed", "alerts")
    ]
    parts.append(spark.table(lake.name("alerts")).agg(F.lit("alerts in the catalog").alias("table"), F.count("*").alias("n")))
    parts.append(spark.range(1).select(F.lit("alerts before").alias("table"), F.lit(before).cast("bigint").alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


register(
    "k08_replay_with_less",
    replayed_with_less,
    with_tables(
        "alerts",
        select="""SELECT 'logs_parsed' AS "table", count(*) AS n FROM logs_parsed UNION ALL SELECT 'alerts', 0
UNION ALL SELECT 'alerts in the catalog', 0 UNION ALL SELECT 'alerts before', count(*) FROM alerts""",
    ),
)

COMPACTED = "2024-01-10"


def compacted(spark, sf_dir):
    """One date of a table that the log job wrote in three batches, folded: rows of each date,
    and whether its files were many and are now one."""
    lake = landed_lake(spark, "compacted", 3, sf_dir=sf_dir)
    path = lake.path("logs_parsed")
    before = U.file_stats(spark, path, "ingest_date").withColumnsRenamed({"files": "files_before", "bytes": "bytes_before"})
    before = stored(before, "files_before")
    U.compact(spark, path, "ingest_date", COMPACTED, new_folder(spark, "staging"), by=("ingest_ts", "raw_log"), closed_batch=2)
    after = U.file_stats(spark, path, "ingest_date")
    files = before.join(after, "ingest_date").select(
        F.col("ingest_date").cast("date").alias("ingest_date"),
        ((F.col("files_before") >= 3) & (F.col("files") == 1)).alias("folded"),
    )
    rows = lake.read(spark, "logs_parsed")
    totals = rows.groupBy("ingest_date").agg(F.count("*").alias("n"), F.sum(F.length("raw_log")).alias("characters"))
    return totals.join(files, "ingest_date")


register(
    "x1_compacted_partition",
    compacted,
    with_tables(
        "logs_parsed",
        select=f"""SELECT ingest_date, count(*) AS n, CAST(sum(length(raw_log)) AS BIGINT) AS characters,
  ingest_date = DATE '{COMPACTED}' AS folded FROM logs_parsed GROUP BY ingest_date""",
    ),
)


def folding(spark, sf_dir):
    """The lake's readers while a date is folded: rows by date before, with the fold recorded and
    nothing moved, with the new files moved in and the old ones still there, and afterwards."""
    lake = landed_lake(spark, "folding", 3, sf_dir=sf_dir)
    path, staging = lake.path("logs_parsed"), new_folder(spark, "staging")

    def seen(step):
        rows = lake.read(spark, "logs_parsed").groupBy("ingest_date").agg(F.count("*").alias("n"), F.sum(F.length("raw_log")).alias("characters"))
        return stored(rows.select(F.lit(step).alias("step"), "*"), "seen")

    steps = [seen("before")]
    of_date = spark.read.option("basePath", path).parquet(path).where(F.col("ingest_date") == F.to_date(F.lit(COMPACTED)))
    old = [r["path"] for r in U.table_files(spark, path).collect() if f"/ingest_date={COMPACTED}/" in r["path"]]
    of_date.withColumn("batch_id", F.lit(0).cast("bigint")).coalesce(1).write.partitionBy("ingest_date", "batch_id").parquet(staging)
    U.record_fold(spark, path, staging, old)
    steps.append(seen("recorded"))
    for row in spark.read.parquet(f"{path}/{FOLDS}/*").where("target is not null").collect():
        move(spark, row["file"], made(spark, row["target"]))
    steps.append(seen("moved"))
    U.resume(spark, path)
    steps.append(seen("after"))
    return reduce(lambda a, b: a.unionByName(b), steps)


register(
    "x1_fold_in_progress",
    folding,
    with_tables(
        "logs_parsed",
        select="""SELECT step, ingest_date, count(*) AS n, CAST(sum(length(raw_log)) AS BIGINT) AS characters
FROM logs_parsed, (VALUES ('before'), ('recorded'), ('moved'), ('after')) AS s(step) GROUP BY step, ingest_date""",
    ),
)

KEEP_DAYS, RETAINED_AT = 7, "2024-01-25"


def lake_retention(spark, sf_dir):
    """Retention of the log job's own tables: rows by date, by path and by catalog, and whether the
    catalog's partitions are the folders that are left."""
    lake = landed_lake(spark, "retention", 2, sf_dir=sf_dir)
    dropped = U.expire_lake(spark, lake, {"logs_parsed": KEEP_DAYS, "alerts": KEEP_DAYS}, RETAINED_AT)["logs_parsed"]
    name, path = lake.name("logs_parsed"), lake.path("logs_parsed")
    left = {(s["ingest_date"], s["batch_id"]) for s in partition_specs(spark, name)}
    there = {tuple(level.split("=")[1] for level in f.rstrip("/").split("/")[-2:]) for f in folders(spark, f"{path}/*/batch_id=*")}
    agree = left == there and not {d for d, _ in left} & {*dropped} and len(dropped) > 0
    by_path = lake.read(spark, "logs_parsed").groupBy("ingest_date").agg(F.count("*").alias("by_path"))
    by_catalog = spark.table(name).groupBy("ingest_date").agg(F.count("*").alias("by_catalog"))
    return by_path.join(by_catalog, "ingest_date", "full").withColumn("partitions_agree", F.lit(agree))


register(
    "x3_lake_retention",
    lake_retention,
    with_tables(
        "logs_parsed",
        select=f"""SELECT ingest_date, count(*) AS by_path, count(*) AS by_catalog, true AS partitions_agree FROM logs_parsed
WHERE ingest_date >= DATE '{RETAINED_AT}' - {KEEP_DAYS} GROUP BY ingest_date""",
    ),
)


def replayed_with_fewer_dates(spark, sf_dir):
    """A batch that is replayed with the rows of some dates only: the dates that the catalog lists."""
    lake = landed_lake(spark, "fewer", 2, sf_dir=sf_dir)
    logs = parse_logs(views.raw_logs(spark, sf_dir)).withColumn("batch_ts", F.to_timestamp(F.lit(DETECTED_AT)))
    for batch in range(2):
        mine = logs.where((F.pmod(F.xxhash64("raw_log"), F.lit(2)) == batch) & (F.dayofmonth("kafka_ts") <= 10))
        etl.land_batch(mine, batch, lake)
    name = lake.name("logs_parsed")
    known = spark.sql(f"SHOW PARTITIONS {name}").select(F.to_date(F.regexp_extract("partition", "ingest_date=([^/]+)", 1)).alias("ingest_date")).distinct()
    rows = spark.table(name).groupBy("ingest_date").agg(F.count("*").alias("n"))
    return known.join(rows, "ingest_date", "left")


register(
    "k07_replay_with_fewer_dates",
    replayed_with_fewer_dates,
    with_tables("logs_parsed", select="SELECT ingest_date, count(*) AS n FROM logs_parsed WHERE day(ingest_date) <= 10 GROUP BY ingest_date"),
)


def bootstrapped(spark, sf_dir):
    """Create the tables twice, append parsed logs by name, count by date."""
    folder = new_folder(spark, "bootstrap")
    lake = Lake(database="siem_" + folder.rsplit("-", 1)[-1], location=folder)
    lake.create_tables(spark)
    lake.append(prepared.logs_parsed(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("bigint")), "logs_parsed")
    lake.create_tables(spark)
    return D.daily_volume(spark.table(lake.name("logs_parsed")))


register(
    "k06_table_bootstrap",
    bootstrapped,
    with_tables("logs_parsed", select="SELECT ingest_date, count(*) AS daily_total FROM logs_parsed GROUP BY 1"),
)


def replayed_batch(spark, sf_dir):
    """Land one batch twice, as after a crash before its commit."""
    lake = Lake(location=new_folder(spark, "replayed"))
    batch = parse_logs(views.raw_logs(spark, sf_dir)).withColumn("batch_ts", F.to_timestamp(F.lit(DETECTED_AT)))
    for _ in range(2):
        etl.land_batch(batch, 7, lake)
    logs = lake.read(spark, "logs_parsed").select(F.lit("logs_parsed").alias("table"))
    alerts = lake.read(spark, "alerts").select(F.lit("alerts").alias("table"))
    return logs.unionAll(alerts).groupBy("table").agg(F.count("*").alias("n"))


register(
    "k08_replayed_batch",
    replayed_batch,
    with_tables(
        "alerts",
        select="""SELECT 'logs_parsed' AS "table", count(*) AS n FROM logs_parsed UNION ALL SELECT 'alerts', count(*) FROM alerts""",
    ),
)


def archived(spark, sf_dir):
    """An archive reader beside the log job, each with its own checkpoint."""
    records = streams.read_record_files(spark, prepared.log_record_files(spark, sf_dir))
    folder = new_folder(spark, "archive")
    etl.start_archive(records, f"{folder}/raw", f"{folder}/checkpoint", ALL).awaitTermination()
    return spark.read.parquet(f"{folder}/raw").select("source_topic", "kafka_ts", "raw_log")


register(
    "t11_archive_reader",
    archived,
    with_tables("raw_logs", select="SELECT source_topic, kafka_ts, raw_log FROM raw_logs"),
)

# -- flow stream --------------------------------------------------------------


def flow_batches(spark, sf_dir):
    """The stream of flow records, in three batches."""
    source = prepared.flow_record_files(spark, sf_dir)
    at_once = prepared.files_per_batch(spark, source, prepared.FLOW_BATCHES)
    return streams.read_record_files(spark, source, (streams.FLOW_TOPIC,), max_files_per_trigger=at_once)


def detector_lake(spark, sf_dir):
    """A lake filled by the flow job: cold start, retraining in every second batch."""

    def write(folder):
        records = flow_batches(spark, sf_dir)
        detector = FlowDetector(Lake(location=folder), retrain_every=2)
        detector.start(records, f"{folder}/checkpoint", ALL).awaitTermination()

    return Lake(location=prepared.written(spark, sf_dir, "detector_lake", write))


def detector_table(name):
    return lambda spark, sf_dir: detector_lake(spark, sf_dir).read(spark, name)


_FLOWS_BY_PROTO = with_tables(
    "flows",
    select="""SELECT proto, count(*) AS n, CAST(sum(orig_bytes) AS BIGINT) AS bytes, CAST(sum(dest_port) AS BIGINT) AS ports
FROM flows GROUP BY proto""",
)


def _by_proto(rows):
    return rows.groupBy("proto").agg(
        F.count("*").alias("n"), F.sum("orig_bytes").alias("bytes"), F.sum("dest_port").alias("ports")
    )


register(
    "s02_flow_stream",
    lambda s, d: _by_proto(
        drained(
            flow_stream(streams.read_record_files(s, prepared.flow_record_files(s, d), (streams.FLOW_TOPIC,))),
            "flow_stream",
        )
    ),
    _FLOWS_BY_PROTO,
)
register("k03_scored_flow_sink", lambda s, d: _by_proto(detector_table("network_flows")(s, d)), _FLOWS_BY_PROTO)


def anomaly_sink(spark, sf_dir):
    """Per date: whether flagged flows and rows of the anomaly table agree, and whether all of
    these are above the threshold."""
    flagged = detector_table("network_flows")(spark, sf_dir).groupBy("ingest_date").agg(
        F.count_if("is_anomaly").alias("flagged_flows")
    )
    kept = detector_table("network_anomalies")(spark, sf_dir).groupBy("ingest_date").agg(
        F.count("*").alias("anomaly_rows"), F.min("anomaly_score").alias("least_score")
    )
    return flagged.join(kept, "ingest_date", "left").select(
        "ingest_date",
        (F.col("flagged_flows") == F.coalesce("anomaly_rows", F.lit(0))).alias("counts_agree"),
        F.coalesce(F.col("least_score") > M.THRESHOLD, F.lit(True)).alias("above_threshold"),
    )


register(
    "k04_anomaly_sink",
    anomaly_sink,
    with_tables(
        "flows",
        select="""SELECT CAST(kafka_ts AS DATE) AS ingest_date, true AS counts_agree, true AS above_threshold FROM flows GROUP BY 1""",
    ),
)


def with_batch_rows(rows, spark, sf_dir, batch):
    """Add whether a training's rows are those of its batch."""
    flows = spark.read.parquet(detector_lake(spark, sf_dir).path("network_flows"))
    sizes = flows.groupBy(F.col("batch_id").alias(batch)).agg(F.count("*").alias("batch_rows"))
    return rows.join(sizes, batch, "left").withColumn("rows_of_batch", F.col("training_rows") == F.col("batch_rows"))


register(
    "k05_model_metrics_sink",
    lambda s, d: with_batch_rows(detector_table("model_metrics")(s, d), s, d, "batch_id").select(
        "training_id", "batch_id", "rows_of_batch", (F.col("wssse") > 0).alias("has_cost"),
        F.col("ingest_ts").isNotNull().alias("has_time"),
    ),
    """SELECT CAST(t AS BIGINT) AS training_id, CAST(b AS BIGINT) AS batch_id, true AS rows_of_batch, true AS has_cost,
  true AS has_time FROM (VALUES (1, 0), (2, 1)) v(t, b)""",
)


def stability(spark, sf_dir):
    """The daily averages against the least and largest cost of the day, by number of days."""
    metrics = detector_table("model_metrics")(spark, sf_dir)
    spans = metrics.groupBy(F.date_trunc("day", "ingest_ts").alias("day")).agg(
        F.min("wssse").alias("least"), F.max("wssse").alias("most"), F.count("*").alias("n")
    )
    return D.model_stability(metrics).join(spans, "day", "full").agg(
        F.sum("n").alias("trainings"),
        F.bool_and(F.col("avg_wssse").between(F.col("least") - 1e-9, F.col("most") + 1e-9)).alias("averages_hold"),
    )


register("q39_model_stability", stability, "SELECT CAST(2 AS BIGINT) AS trainings, true AS averages_hold")


def model_versions(spark, sf_dir):
    """Saved models: version, batch that trained them, whether on its rows, centers."""
    models = ModelStore(spark, f"{detector_lake(spark, sf_dir).location}/models").table()
    return with_batch_rows(models, spark, sf_dir, "trained_at_batch").select(
        "version", "trained_at_batch", "rows_of_batch", F.size("centers").alias("clusters"), (F.col("wssse") > 0).alias("has_cost")
    )


register(
    "m08_retrained_models",
    model_versions,
    """SELECT v AS version, CAST(b AS BIGINT) AS trained_at_batch, true AS rows_of_batch, 8 AS clusters, true AS has_cost
FROM (VALUES (1, 0), (2, 1)) t(v, b)""",
)


def cold_start(spark, sf_dir):
    """Cold start that needs more than the first batch: nothing of it may be lost."""
    records = flow_batches(spark, sf_dir)
    lake = Lake(location=new_folder(spark, "cold_lake"))
    rows = spark.read.parquet(prepared.flow_record_files(spark, sf_dir)).count()
    detector = FlowDetector(lake, cold_start_rows=rows // 2, retrain_every=1000)
    detector.start(records, f"{lake.location}/checkpoint", ALL).awaitTermination()
    return _by_proto(lake.read(spark, "network_flows"))


# Means and deviations of the baseline, and how many points its centers stand for.
BASE_MEAN, BASE_STD, BASE_WEIGHT, DECAY = (1.25, 15.0, 7.5, 0.75, 0.1), (0.5, 0.75, 1.0, 0.4375, 0.3125), 100.0, 0.9


def _tens(column):
    """Which third of the month a flow arrived in."""
    return F.least(F.floor((F.dayofmonth(column) - 1) / 10), F.lit(2)).cast("int")


def flow_thirds(spark, sf_dir):
    """Flow records in files of their own for each third of the month, in that order."""

    def write(folder):
        parts = prepared.record_parts(views.table(spark, sf_dir, "lineitem"), 3)
        rows = prepared.flow_json(views.flows(spark, sf_dir)).select(
            F.lit(streams.FLOW_TOPIC).alias("topic"), F.col("kafka_ts").alias("timestamp"), F.col("raw_log").cast("binary").alias("value")
        )
        for third in range(3):
            rows.where(_tens("timestamp") == third).coalesce(parts).write.mode("append").parquet(folder)

    return prepared.written(spark, sf_dir, "flow_thirds", write)


def decaying_lake(spark, sf_dir):
    """A lake filled by the job with moving centers, stopped after the first batch and restarted."""

    def write(folder):
        source, staged = flow_thirds(spark, sf_dir), new_folder(spark, "decaying")
        base = M.ClusterModel(P.FEATURES, BASE_MEAN, BASE_STD, tuple(map(tuple, views.CENTERS)), (BASE_WEIGHT,) * len(views.CENTERS))
        for step in ((0,), (1, 2)):
            made, at_once = 0, prepared.files_per_batch(spark, source, 3)
            for third in step:
                rows = spark.read.parquet(source).where(_tens("timestamp") == third)
                if not rows.isEmpty():
                    before = len(folders(spark, f"{staged}/*.parquet"))
                    rows.coalesce(at_once).write.mode("append").parquet(staged)
                    # A third is one batch, so the next one gets no more files than this.
                    made = made or len(folders(spark, f"{staged}/*.parquet")) - before
                    at_once = made
            records = streams.read_record_files(spark, staged, (streams.FLOW_TOPIC,), max_files_per_trigger=at_once)
            DecayingDetector(Lake(location=folder), base, DECAY).start(records, f"{folder}/checkpoint", ALL).awaitTermination()

    return Lake(location=prepared.written(spark, sf_dir, "decaying_lake", write))


def decaying_centers(spark, sf_dir):
    """The centers and weights after each batch."""
    models = ModelStore(spark, f"{decaying_lake(spark, sf_dir).location}/decayed_models").table()
    each = models.select("trained_at_batch", F.posexplode(F.arrays_zip("centers", "weights")).alias("cluster_id", "x"))
    return each.select(
        F.col("trained_at_batch").alias("batch_id"), "cluster_id", rounded(F.col("x.weights"), 4).alias("weight"),
        *[rounded(F.col("x.centers")[i], 4).alias(f"c{i}") for i in range(5)],
    )


def _decayed_sql():
    """Three updates in turn, each assigning its third of the flows to the centers of the one before."""
    z = ", ".join(f"({c} - {m!r}) / {s!r} AS z{i}" for i, (c, m, s) in enumerate(zip(("a", "b", "c", "is_dst_external", "is_src_server"), BASE_MEAN, BASE_STD)))
    extra = {
        "each": f"SELECT least((day(kafka_ts) - 1) // 10, 2) AS third, {z} FROM featured",
        "points": "SELECT third, z0, z1, z2, z3, z4, count(*) AS n FROM each GROUP BY ALL",
        "m0": " UNION ALL ".join(f"SELECT {n} AS id, CAST({BASE_WEIGHT} AS DOUBLE) AS w, " + ", ".join(f"CAST({x} AS DOUBLE) AS o{i}" for i, x in enumerate(c)) for n, c in enumerate(views.CENTERS)),
    }
    for step in range(3):
        gap = " + ".join(f"(z{i} - o{i}) * (z{i} - o{i})" for i in range(5))
        sums = ", ".join(f"sum(n * z{i}) AS s{i}" for i in range(5))
        extra[f"near{step}"] = f"""SELECT z0, z1, z2, z3, z4, any_value(n) AS n, arg_min(id, (d, id)) AS id FROM (
    SELECT p.*, id, {gap} AS d FROM points p, m{step} WHERE third = {step}) GROUP BY z0, z1, z2, z3, z4"""
        extra[f"sums{step}"] = f"SELECT id, sum(n) AS m, {sums} FROM near{step} GROUP BY id"
        moved = ", ".join(f"(o{i} * w * {DECAY} + coalesce(s{i}, 0)) / (w * {DECAY} + coalesce(m, 0)) AS o{i}" for i in range(5))
        extra[f"m{step + 1}"] = f"SELECT c.id, w * {DECAY} + coalesce(m, 0) AS w, {moved} FROM m{step} c LEFT JOIN sums{step} s ON s.id = c.id"
    rows = [
        f"SELECT CAST({step} AS BIGINT) AS batch_id, CAST(id AS INT) AS cluster_id, {rnd('w', 4)} AS weight, " + ", ".join(f"{rnd(f'o{i}', 4)} AS c{i}" for i in range(5)) + f" FROM m{step + 1}"
        for step in range(3)
    ]
    return with_tables("featured", select=" UNION ALL ".join(rows), extra=extra)


def changing_list(spark, sf_dir):
    """Flows in batches of a third of the month; half of the indicators are listed after the first."""
    source, staged, folder = flow_thirds(spark, sf_dir), new_folder(spark, "hunted"), new_folder(spark, "hunt")
    listed = views.indicators(spark, sf_dir).select(F.col("indicator").alias("src_ip")).distinct()
    early = F.pmod(F.regexp_extract("src_ip", "([0-9]+)$", 1).cast("int"), F.lit(2)) == 0
    hunt = IndicatorHunt(f"{folder}/found", lambda s: s.read.parquet(f"{folder}/list"), "src_ip")
    for step in range(3):
        listed.where(early if step == 0 else F.lit(True)).write.mode("overwrite").parquet(f"{folder}/list")
        spark.read.parquet(source).where(_tens("timestamp") == step).coalesce(prepared.files_per_batch(spark, source, 3)).write.mode("append").parquet(staged)
        flows = flow_stream(streams.read_record_files(spark, staged, (streams.FLOW_TOPIC,)))
        hunt.start(flows, f"{folder}/checkpoint", ALL).awaitTermination()
    return hunt.read(spark, flows.select("uid", "src_ip", "kafka_ts").schema)


register(
    "j2_stream_changing_list",
    changing_list,
    with_tables(
        "flows", "indicators",
        select="""SELECT uid, src_ip, kafka_ts FROM flows WHERE src_ip IN (SELECT indicator FROM indicators)
  AND (day(kafka_ts) > 10 OR CAST(regexp_extract(src_ip, '([0-9]+)$', 1) AS INT) % 2 = 0)""",
    ),
)
register("m12_moving_centers", decaying_centers, _decayed_sql())
register(
    "m12_flows_scored_once",
    lambda s, d: _by_proto(decaying_lake(s, d).read(s, "network_flows")).select("proto", "n"),
    with_tables("flows", select="SELECT proto, count(*) AS n FROM flows GROUP BY proto"),
)
register("m07_cold_start", cold_start, _FLOWS_BY_PROTO)


def notebook_learning(spark, sf_dir):
    """Continuous learning from the notebook baseline over three batches: the models left."""
    flows = M.baseline_rows(views.flows(spark, sf_dir))
    lake = Lake(location=new_folder(spark, "notebook_lake"))
    detector = NotebookDetector(lake, M.train(flows, RAW_FEATURES))
    records = flow_batches(spark, sf_dir)
    query = (
        flow_stream(records).writeStream.foreachBatch(detector.process)
        .option("checkpointLocation", f"{lake.location}/checkpoint").trigger(**ALL).start()
    )
    query.awaitTermination()
    return ModelStore(spark, f"{lake.location}/notebook_models").table().agg(
        F.count("*").alias("models"),
        F.max("version").alias("last_version"),
        F.max("trained_at_batch").alias("last_batch"),
        F.sum("training_rows").alias("training_rows"),
        F.min(F.size("centers")).alias("clusters"),
    )


register(
    "m11_continuous_learning",
    notebook_learning,
    with_tables(
        "flows",
        select="""SELECT CAST(3 AS BIGINT) AS models, 4 AS last_version, CAST(2 AS BIGINT) AS last_batch, count(*) AS training_rows,
  8 AS clusters FROM flows WHERE dest_port IS NOT NULL AND duration IS NOT NULL AND orig_bytes IS NOT NULL AND resp_bytes IS NOT NULL""",
    ),
)

# -- event time ---------------------------------------------------------------

_FINAL = "window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 15 MINUTE"


def _final_windows(body):
    return f"SELECT * FROM ({body}) WHERE {_FINAL}"


register(
    "w3_event_sequence_stream",
    lambda s, d: drained(
        H.followed_by_stream(event_stream(s, d), "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "1 DAY"),
        "sequences",
    ),
    """SELECT a.user_id, a.ts AS first_at, min(b.ts) AS then_at FROM (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup') a
JOIN events b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 DAY
WHERE a.ts <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 15 MINUTE - INTERVAL 1 DAY GROUP BY a.user_id, a.ts""",
)
def still_open(spark, sf_dir):
    """The windows that a stream over all events holds in its state at the end, read from there."""
    folder = new_folder(spark, "open")
    rows = H.tumbling_counts(event_stream(spark, sf_dir), "ts", ["user_id"], watermark="15 minutes")
    query = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").trigger(**ALL).start()
    )
    query.awaitTermination()
    return windows.open_windows(spark, f"{folder}/checkpoint")


register(
    "t09_open_windows",
    still_open,
    """SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
  AS window_end, user_id, count(*) AS n FROM events GROUP BY ALL)
WHERE window_end > (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 15 MINUTE""",
)
register(
    "t05_tumbling_stream",
    lambda s, d: drained(
        H.tumbling_counts(event_stream(s, d), "ts", ["user_id"], watermark="15 minutes"), "tumbling"
    ),
    _final_windows(
        """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, user_id, count(*) AS n FROM events GROUP BY ALL"""
    ),
)


def durable_counts(spark, sf_dir):
    """The same windows with the state in the durable store, and whether that store wrote it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    checkpoint = new_folder(spark, "checkpoint")
    windows.use_durable_state(spark)
    try:
        rows = H.tumbling_counts(event_stream(spark, sf_dir), "ts", ["user_id"], watermark="15 minutes")
        folder = new_folder(spark, "durable")
        query = (
            rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", folder).trigger(**ALL).start()
        )
        query.awaitTermination()
        used = query.lastProgress["stateOperators"][0]["customMetrics"]
    finally:
        spark.conf.set(key, before)
    durable = any(name.startswith("rocksdb") for name in used)
    return spark.read.schema(rows.schema).parquet(folder).withColumn("durable", F.lit(durable))


register(
    "t09_durable_state",
    durable_counts,
    "SELECT *, true AS durable FROM ("
    + _final_windows(
        """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, user_id, count(*) AS n FROM events GROUP BY ALL"""
    )
    + ")",
)


def failed_login_stream(spark, sf_dir):
    logs = parse_logs(views.raw_logs_of(event_stream(spark, sf_dir))).select("ingest_ts", "raw_log", "syslog_host")
    failed = F.col("raw_log").like("%Failed password%")
    return drained(
        H.sliding_counts_stream(logs, "ingest_ts", ["syslog_host"], "15 minutes", only=failed), "sliding"
    )


register(
    "t06_sliding_stream",
    failed_login_stream,
    with_tables(
        "logs_parsed",
        select=_final_windows(
            """SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, syslog_host, count(*) AS n FROM (
  SELECT date_trunc('minute', ingest_ts) - to_minutes(unnest(range(5))) AS w, syslog_host FROM logs_parsed
  WHERE contains(raw_log, 'Failed password')) GROUP BY ALL"""
        ),
    ),
)
LATE_FROM = "2024-01-15 12:00:00"


def late_events(spark, sf_dir):
    """The second half of the month first, the first half after a restart: all of it is late."""
    folder, out, checkpoint = (new_folder(spark, n) for n in ("late_input", "late_output", "checkpoint"))
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    on_time = F.col("ts") >= F.to_timestamp(F.lit(LATE_FROM))
    for part in (on_time, ~on_time):
        events.filter(part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        counted = H.tumbling_counts(stream, "ts", ["user_id"], watermark="15 minutes")
        query = (
            counted.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", out).trigger(**ALL).start()
        )
        query.awaitTermination()
    return spark.read.schema(counted.schema).parquet(out)


register(
    "t07_late_events_dropped",
    late_events,
    _final_windows(
        f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, user_id, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '{LATE_FROM}' GROUP BY ALL"""
    ),
)


def deduplicated_stream(spark, sf_dir):
    """Every event sent twice, as by a sender that retries."""
    folder = new_folder(spark, "sent_twice")
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.unionByName(events).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    once = H.deduplicate_stream(stream, ["event_id"], "ts", "15 minutes")
    return drained(once.select("event_id", "user_id", "event_type"), "deduplicated")


register("t08_deduplicated_stream", deduplicated_stream, "SELECT event_id, user_id, event_type FROM events")


def windowed_rules_stream(spark, sf_dir):
    logs = parse_logs(views.raw_logs_of(event_stream(spark, sf_dir)))
    rules = R.select_rules(thresholds=WINDOW_THRESHOLDS)
    hits = windows.windowed_hits_stream(logs, rules, "1 day", "15 minutes")
    return drained(hits.drop("rule_name", "severity", "description"), "windowed_rules")


register(
    "t10_windowed_rules_stream",
    windowed_rules_stream,
    with_tables(
        "logs_parsed",
        select=_final_windows(
            "SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, rule_id, matched_field, "
            "matched_value, hit_count FROM ("
            + " UNION ALL ".join(
                rule_select(r, "dated", "window_start, ", having=f"> {WINDOW_THRESHOLDS.get(r[0], 0)}") for r in RULES
            )
            + ")"
        ),
        extra={"dated": "SELECT *, date_trunc('day', ingest_ts) AS window_start FROM logs_parsed"},
    ),
)


def correlated(spark, sf_dir):
    def side(kind, time):
        return event_stream(spark, sf_dir).filter(F.col("event_type") == kind).select(
            "user_id", F.col("ts").cast("timestamp").alias(time)
        )

    pairs = windows.correlate_streams(
        side("signup", "signed_at"), side("purchase", "bought_at"), "user_id", "signed_at", "bought_at", "6 HOURS"
    )
    return drained(pairs, "correlated")


register(
    "j4_stream_stream_join",
    correlated,
    """SELECT a.user_id, a.ts AS signed_at, b.ts AS bought_at FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'signup' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 6 HOUR""",
)

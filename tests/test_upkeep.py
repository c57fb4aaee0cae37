"""Retention, folds and moving centers on the lake's own layout."""

import datetime as dt

from pyspark.sql import functions as F

from loghaven import jobs
from loghaven.lake import BATCH, FOLDS, Lake, drop_partitions, folders, partition_specs, stored
from loghaven.operators import anomaly
from loghaven.operators import maintenance as U
from loghaven.operators.features import FEATURES
from loghaven.streaming.detector import DecayingDetector
from loghaven.streaming.models import ModelStore

DAY = dt.datetime(2024, 3, 1, 12)


def metric_lake(spark, folder, name):
    lake = Lake(database=name, location=folder)
    lake.create_tables(spark)
    for batch in range(3):
        rows = [(f"line {batch} {day}", DAY + dt.timedelta(days=day)) for day in range(5) for _ in range(4)]
        logs = spark.createDataFrame(rows, "raw_log string, ingest_ts timestamp").withColumn("ingest_date", F.to_date("ingest_ts"))
        missing = {f.name: F.lit(None).cast(f.dataType) for f in spark.table(lake.name("logs_parsed")).schema if f.name not in (*logs.columns, BATCH)}
        lake.write_batch(logs.withColumns(missing), "logs_parsed", batch)
    return lake


def dates(rows):
    return {str(r[0]): r[1] for r in rows.groupBy("ingest_date").count().collect()}


def test_retention_by_catalog_and_by_path(spark, folder):
    lake = metric_lake(spark, folder, "upkeep_a")
    name, path = lake.name("logs_parsed"), lake.path("logs_parsed")
    assert len(partition_specs(spark, name)) == 15
    assert U.expire_lake(spark, lake, {"logs_parsed": 2}, "2024-03-05") == {"logs_parsed": ["2024-03-01", "2024-03-02"]}
    left = {f"2024-03-0{d}": 12 for d in (3, 4, 5)}
    assert dates(spark.table(name)) == dates(lake.read(spark, "logs_parsed")) == left
    assert len(partition_specs(spark, name)) == 9 and len(folders(spark, f"{path}/ingest_date=*")) == 3
    assert U.expire_lake(spark, lake, {"logs_parsed": 2}, "2024-03-05") == {"logs_parsed": []}
    drop_partitions(spark, name, partition_specs(spark, name))
    spark.sql("DROP TABLE upkeep_a.logs_parsed")
    assert U.expire_lake(spark, lake, {"logs_parsed": 1}, "2024-03-05") == {"logs_parsed": ["2024-03-03"]}
    assert dates(lake.read(spark, "logs_parsed")) == {f"2024-03-0{d}": 12 for d in (4, 5)}


def test_rows_without_a_date_stay(spark, folder):
    spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 1))], "v int, d date").write.partitionBy("d").option("path", folder).saveAsTable("undated")
    assert U.expire(spark, "undated", "d", 1, "2024-03-05") == ["2024-01-01"]
    assert [r.v for r in spark.table("undated").collect()] == [1]


def test_replay_leaves_no_stale_partitions(spark, folder):
    lake = metric_lake(spark, folder, "upkeep_b")
    once = stored(lake.read(spark, "logs_parsed").where("ingest_date = DATE'2024-03-04' AND raw_log LIKE 'line 1%'"), "once")
    lake.write_batch(once, "logs_parsed", 1)
    kept = {(s["ingest_date"], s[BATCH]) for s in partition_specs(spark, lake.name("logs_parsed"))}
    assert {d for d, b in kept if b == "1"} == {"2024-03-04"} and len(kept) == 11


def test_a_lost_fold_is_ended(spark, folder):
    """The record stands: readers see each row once, whatever of the rest was done."""
    lake = metric_lake(spark, folder, "upkeep_c")
    path, whole = lake.path("logs_parsed"), dates(lake.read(spark, "logs_parsed"))
    day = spark.read.option("basePath", path).parquet(path).where("ingest_date = DATE'2024-03-02'")
    old = [r["path"] for r in U.table_files(spark, path).collect() if "/ingest_date=2024-03-02/" in r["path"]]
    staging = f"{folder}/staging"
    day.withColumn(BATCH, F.lit(0).cast("bigint")).repartition(2).write.partitionBy("ingest_date", BATCH).parquet(staging)
    U.record_fold(spark, path, staging, old)
    assert dates(lake.read(spark, "logs_parsed")) == whole
    assert U.resume(spark, path) == 1 and U.resume(spark, path) == 0
    assert dates(lake.read(spark, "logs_parsed")) == whole and not folders(spark, f"{path}/{FOLDS}/*")
    assert len(folders(spark, f"{path}/ingest_date=2024-03-02/*/*.parquet")) == 2


def test_upkeep_job_folds_and_drops(spark, folder, capsys):
    lake = metric_lake(spark, folder, "upkeep_d")
    jobs.upkeep(spark, lake, "logs_parsed", 3, "2024-03-04", 1, "2024-03-05")
    assert capsys.readouterr().out.splitlines() == ["dropped\tlogs_parsed\t2024-03-01", "folded\tlogs_parsed\t2024-03-04\t1"]
    specs = {(s["ingest_date"], s[BATCH]) for s in partition_specs(spark, lake.name("logs_parsed"))}
    assert {b for d, b in specs if d == "2024-03-04"} == {"0", "2"}
    assert dates(spark.table(lake.name("logs_parsed"))) == {f"2024-03-0{d}": 12 for d in (2, 3, 4, 5)}


def test_moving_centers_are_carried_over_and_not_moved_twice(spark, folder):
    lake = Lake(location=folder)
    base = anomaly.ClusterModel(FEATURES, (0.0,) * 5, (1.0,) * 5, ((0.0,) * 5, (5.0, 5.0, 5.0, 1.0, 0.0)), (2.0, 2.0))
    schema = "kafka_ts timestamp, ts double, event_time timestamp, uid string, src_ip string, src_port int, dest_ip string, dest_port int, proto string, service string, duration double, orig_bytes long, resp_bytes long, conn_state string, batch_ts timestamp"

    def batch(n, size):
        row = (DAY, 1.0, DAY, "u", "10.0.0.1", 1, "8.8.8.8", 2, "tcp", None, size, 150, 150, "SF", DAY)
        return spark.createDataFrame([row] * n, schema)

    def centers(store):
        return [(m.trained_at_batch, m.weights, [round(x, 6) for x in m.centers[1]]) for m in (store.at_batch(0), store.at_batch(1)) if m]

    detector = DecayingDetector(lake, base, decay=0.5)
    detector.process(batch(3, 100.0), 0)
    detector.process(batch(0, 0.0), 1)
    detector.process(batch(1, 200.0), 1)
    store = ModelStore(spark, detector.path)
    once = centers(store)
    assert [w for _, w, _ in once] == [(1.0, 4.0), (0.5, 3.0)]
    DecayingDetector(lake, base, decay=0.5).process(batch(1, 200.0), 1)  # restarted, replayed
    assert centers(store) == once
    assert lake.read(spark, "network_flows").count() == 4
    DecayingDetector(lake, base, half_life=1.0).process(batch(1, 200.0), 2)
    assert store.latest().weights == (0.25, 2.5)

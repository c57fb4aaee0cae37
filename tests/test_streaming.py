"""Streaming jobs: exactly-once landing, restart after a crash, cold start, retraining."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loghaven.lake import Lake, new_folder, write_batch
from loghaven.operators import hunting as H
from loghaven.operators import rules as R
from loghaven.sources.streams import read_record_files
from loghaven.streaming import etl, windows
from loghaven.streaming.detector import FlowDetector
from loghaven.streaming.models import ModelStore

TS = dt.datetime(2024, 5, 6, 7, 8, 9)
ALL = {"availableNow": True}


def write_records(spark, folder, topic, lines, ts=TS):
    df = spark.createDataFrame([(topic, ts, bytearray(x.encode())) for x in lines], "topic string, timestamp timestamp, value binary")
    df.coalesce(1).write.mode("append").parquet(folder)


def web(n, status="401"):
    return [f'1.1.1.1 - - [x] "GET /{i} HTTP/1.1" {status} 5' for i in range(n)]


def flow(i):
    return (
        f'{{"ts":{i},"uid":"u{i}","id.orig_h":"10.0.0.{i % 5}","id.resp_h":"8.8.8.{i % 7}","id.resp_p":{i % 9 + 1},'
        f'"duration":{i % 11},"orig_bytes":{i * 37 % 1000},"resp_bytes":{i * 91 % 700},"conn_state":"SF"}}'
    )


def test_log_job_lands_logs_and_alerts(spark, folder):
    source, lake = f"{folder}/in", Lake(location=f"{folder}/lake")
    write_records(spark, source, "web-logs", web(60))
    records = read_record_files(spark, source)
    etl.start_log_etl(records, lake, f"{folder}/cp", trigger=ALL).awaitTermination()
    assert lake.read(spark, "logs_parsed").count() == 60
    alert, = lake.read(spark, "alerts").collect()
    assert (alert.rule_id, alert.matched_value, alert.hit_count) == ("SIEM-001", "1.1.1.1", 60)
    # A second run finds nothing new; a new file is a new batch.
    etl.start_log_etl(records, lake, f"{folder}/cp", trigger=ALL).awaitTermination()
    assert lake.read(spark, "logs_parsed").count() == 60
    write_records(spark, source, "web-logs", web(5))
    etl.start_log_etl(records, lake, f"{folder}/cp", trigger=ALL).awaitTermination()
    assert lake.read(spark, "logs_parsed").count() == 65
    assert lake.read(spark, "alerts").count() == 1


def test_crash_between_write_and_commit_leaves_no_duplicates(spark, folder):
    source, lake = f"{folder}/in", Lake(location=f"{folder}/lake")
    write_records(spark, source, "web-logs", web(60))

    def crash_after_landing(batch, batch_id):
        etl.land_batch(batch, batch_id, lake)
        raise RuntimeError("executor lost")

    stream = etl.parsed_stream(read_record_files(spark, source))
    query = stream.writeStream.option("checkpointLocation", f"{folder}/cp").foreachBatch(crash_after_landing)
    with pytest.raises(Exception, match="executor lost"):
        query.trigger(**ALL).start().awaitTermination()
    first = lake.read(spark, "alerts").first()
    etl.start_log_etl(read_record_files(spark, source), lake, f"{folder}/cp", trigger=ALL).awaitTermination()
    assert lake.read(spark, "logs_parsed").count() == 60
    assert lake.read(spark, "alerts").collect() == [first]  # also the same detection time


def test_empty_lake_reads_empty(spark, folder):
    assert Lake(location=folder).read(spark, "alerts").count() == 0


def test_batch_rewrite_replaces_only_its_own_rows(spark, folder):
    rows = spark.range(10).select(F.col("id"), F.lit("2024-01-01").cast("date").alias("d"))
    write_batch(rows, folder, "d", 1)
    write_batch(rows, folder, "d", 2)
    write_batch(rows, folder, "d", 2)
    got = {r.batch_id: r["count"] for r in spark.read.parquet(folder).groupBy("batch_id").count().collect()}
    assert got == {1: 10, 2: 10}


def run_detector(spark, folder, detector):
    records = read_record_files(spark, f"{folder}/in", ("real_network_logs",))
    detector.start(records, f"{folder}/cp", ALL).awaitTermination()


def test_cold_start_scores_all_buffered_rows_and_retrains(spark, folder):
    lake = Lake(location=f"{folder}/lake")
    detector = FlowDetector(lake, k=3, cold_start_rows=100, retrain_every=2)
    store = ModelStore(spark, f"{lake.location}/models")
    sizes = [60, 60, 120, 40, 50]
    start = 0
    for n in sizes:
        write_records(spark, f"{folder}/in", "real_network_logs", [flow(start + i) for i in range(n)])
        start += n
        run_detector(spark, folder, detector)
        if start == 60:
            assert store.first() is None and lake.read(spark, "network_flows").count() == 0
    flows = lake.read(spark, "network_flows")
    assert flows.count() == sum(sizes) and flows.select("uid").distinct().count() == sum(sizes)
    assert flows.filter("anomaly_score < 0 OR cluster_id NOT BETWEEN 0 AND 2").count() == 0
    # Trained on the 120 buffered rows in batch 1, again on batch 2; batch 4 was too small.
    got = [(r.version, r.trained_at_batch, r.training_rows) for r in store.table().orderBy("version").collect()]
    assert got == [(1, 1, 120), (2, 2, 120)]
    assert lake.read(spark, "model_metrics").count() == 2
    flagged = flows.filter("is_anomaly").count()
    assert lake.read(spark, "network_anomalies").count() == flagged


def test_replayed_detector_batches_change_nothing(spark, folder):
    lake = Lake(location=f"{folder}/lake")
    detector = FlowDetector(lake, k=3, cold_start_rows=100, retrain_every=2)
    store = ModelStore(spark, f"{lake.location}/models")
    from loghaven.streaming.detector import flow_stream

    batches = []
    for b in range(3):
        records = spark.createDataFrame(
            [("real_network_logs", TS, bytearray(flow(b * 110 + i).encode())) for i in range(110)],
            "topic string, timestamp timestamp, value binary",
        )
        batches.append(flow_stream(records).withColumn("batch_ts", F.lit(TS)))
    for b in (0, 0, 1, 2, 2):
        detector.process(batches[b], b)
    assert lake.read(spark, "network_flows").count() == 330
    assert [(r.version, r.trained_at_batch) for r in store.table().orderBy("version").collect()] == [(1, 0), (2, 1)]
    assert store.latest(before_batch=1).version == 1 and store.latest().version == 2
    assert lake.read(spark, "model_metrics").count() == 2


def test_errors_stop_the_query(spark, folder):
    write_records(spark, f"{folder}/in", "web-logs", web(1))
    bad = R.SqlRule("U", "n", "LOW", "d", "SELECT no_such_column FROM batch_logs")
    query = etl.start_log_etl(
        read_record_files(spark, f"{folder}/in"), Lake(location=f"{folder}/lake"), f"{folder}/cp", [bad], trigger=ALL
    )
    with pytest.raises(Exception, match="no_such_column"):
        query.awaitTermination()


def test_late_rows_are_counted_as_dropped(spark, folder):
    schema = "user string, ts timestamp"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = (
            H.tumbling_counts(stream, "ts", ["user"], watermark="15 minutes").writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(**ALL).start()
        )
        query.awaitTermination()
        return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)

    assert run([("a", TS), ("a", TS + dt.timedelta(hours=1))]) == 0
    assert run([("a", TS), ("a", TS + dt.timedelta(hours=2))]) == 1
    got = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.window_start, r.n) for r in got) == [
        (dt.datetime(2024, 5, 6, 7, 5), 1), (dt.datetime(2024, 5, 6, 8, 5), 1),
    ]


def test_windowed_rules_stream_equals_batch(spark, folder):
    source = f"{folder}/in"
    for minutes, n in ((0, 60), (3, 20), (7, 55)):
        write_records(spark, source, "web-logs", web(n), TS + dt.timedelta(minutes=minutes))
    write_records(spark, source, "syslogs", ["x"], TS + dt.timedelta(hours=3))
    logs = etl.parsed_stream(read_record_files(spark, source))
    rules = R.select_rules("SIEM-001")
    query = (
        windows.windowed_hits_stream(logs, rules).writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(**ALL).start()
    )
    query.awaitTermination()
    batch = etl.parsed_stream(spark.read.parquet(source))
    want = {(r.window_start, r.matched_value, r.hit_count) for r in R.windowed_hits(batch, rules).collect()}
    got = {(r.window_start, r.matched_value, r.hit_count) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == want and len(want) == 2


def test_settings(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        windows.use_durable_state(spark)
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        folder = new_folder(spark, "rocks")
        schema = "user string, ts timestamp"
        spark.createDataFrame([("a", TS), ("b", TS + dt.timedelta(hours=1))], schema).write.parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = (
            H.tumbling_counts(stream, "ts", ["user"], watermark="1 minute").writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(**ALL).start()
        )
        query.awaitTermination()
        assert spark.read.parquet(f"{folder}/out").count() == 1
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    windows.watermark_policy(spark, "max")
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max"
    windows.watermark_policy(spark, "min")
    with pytest.raises(ValueError):
        windows.watermark_policy(spark, "mean")

"""Tables and files that the queries derive: no task, file or shuffle grows with the whole table."""

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from pyspark import StorageLevel

from checks import hunt_queries, prepared, source_queries, stream_queries, views
from checks.registry import QUERIES
from loghaven import lake as lakes
from loghaven.lake import folders, write_batch, write_in_place
from loghaven.operators import maintenance as U
from loghaven.streaming import detector

ROWS = 240


@pytest.fixture
def small_files(spark, folder, monkeypatch):
    """A table of line items, and files of 20 rows."""
    monkeypatch.setattr(prepared, "FILE_ROWS", 20)
    monkeypatch.setattr(source_queries, "FILE_LINES", 20)
    i = F.col("id").cast("int")
    spark.range(0, ROWS, 1, 2).select(
        (i + 1).cast("long").alias("l_orderkey"), (i % 50).cast("long").alias("l_partkey"), (i % 20).cast("long").alias("l_suppkey"),
        (i % 7 + 1).alias("l_linenumber"), F.lit(5.0).alias("l_quantity"), (i * 10.0).alias("l_extendedprice"),
        F.lit(0.5).alias("l_discount"), F.lit("A").alias("l_returnflag"), F.lit(dt.date(2024, 1, 2)).alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_record_files_grow_in_number(spark, small_files):
    source = prepared.flow_record_files(spark, small_files)
    files = spark.read.parquet(source).groupBy(F.input_file_name()).count()
    assert files.agg(F.sum("count"), F.max("count") < ROWS / 3).first()[:] == (ROWS, True)
    assert prepared.files_per_batch(spark, source, 3) > 1
    assert len(folders(spark, f"{stream_queries.flow_thirds(spark, small_files)}/*.parquet")) > 3


def test_batches_stay_three(spark, small_files):
    rows = spark.read.parquet(stream_queries.detector_lake(spark, small_files).path("network_flows"))
    assert sorted(rows.groupBy("batch_id").count().toPandas()["batch_id"]) == [0, 1, 2] and rows.count() == ROWS
    lake = stream_queries.decaying_lake(spark, small_files)
    days = spark.read.parquet(lake.path("network_flows")).groupBy("batch_id").agg(F.min(F.dayofmonth("ingest_ts")), F.max(F.dayofmonth("ingest_ts")), F.count("*"))
    got = sorted(map(tuple, days.collect()))
    assert [r[0] for r in got] == [0, 1, 2] and sum(r[3] for r in got) == ROWS
    assert got[0][2] <= 10 < got[1][1] and got[1][2] <= 20 < got[2][1]


def test_sorted_files_in_parts(spark, small_files, monkeypatch):
    parts, made = [], U.sorted_for_pruning
    monkeypatch.setattr(U, "sorted_for_pruning", lambda rows, by, files: parts.append(files) or made(rows, by, files))
    assert hunt_queries.sorted_files(spark, small_files).first()["files"] == 8
    assert parts == [16]


def test_text_files_are_compressed_and_bounded(spark, small_files):
    lines = spark.read.text(source_queries.json_files(spark, small_files))
    files = lines.groupBy(F.input_file_name().alias("file")).count().collect()
    assert all(f["file"].endswith(".gz") and f["count"] <= 20 for f in files) and sum(f["count"] for f in files) == ROWS
    got = {(r.source_file, r.n) for r in QUERIES["s09_route_files"](spark, small_files).collect()}
    assert got == {("conn.log", ROWS), ("http.log", ROWS), ("ssl.log", ROWS)}
    assert QUERIES["s05_zeek_tsv"](spark, small_files).where("uid LIKE 'C%' AND conn_state IS NOT NULL AND proto = 'tcp'").count() == ROWS


def test_tsv_files_are_written_where_the_rows_are(spark, small_files):
    assert "Exchange" not in plan_of(source_queries.tsv_lines(views.flows(spark, small_files)))
    lines = spark.read.text(f"{source_queries.mixed_files(spark, small_files)}/file_name=conn.log").select("value", F.input_file_name().alias("file"))
    heads = F.count_if(F.col("value").startswith("#fields"))
    files = lines.groupBy("file").agg(F.count("*").alias("n"), heads.alias("heads"), F.first("value").alias("first")).collect()
    assert len(files) >= ROWS / 20 and all(f["n"] <= 22 and f["heads"] == 1 and f["first"].startswith("#separator") for f in files)
    assert lines.where("value LIKE '#fields%'").select("value").distinct().count() == 3


def test_record_batches_follow_each_other(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, n // 2 % 40), f"u{n % 7}") for n in range(400)] + [(None, "u"), (None, None), (dt.datetime(2024, 1, 1), None)] * 3
    flows = spark.createDataFrame(rows, "kafka_ts timestamp, uid string")
    key = F.struct("kafka_ts", "uid")
    spans = [flows.where(b).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")) for b in prepared.batch_bounds(flows, 3)]
    got = [s.select("n", "low", "high").first() for s in spans]
    assert sum(g["n"] for g in got) == len(rows) and all(100 < g["n"] < 170 for g in got)
    above = [spans[n].crossJoin(spans[n + 1].select(F.col("low").alias("next"))).select(F.col("high") < F.col("next")).first()[0] for n in range(2)]
    assert above == [True, True]
    assert len(prepared.batch_bounds(flows.limit(0), 3)) >= 1


def test_flow_records_and_cold_start_leave_rows_where_they_are(spark, small_files, monkeypatch):
    frame, hinted, on_disk, ranged = type(spark.range(1)), [], [], []
    persist, balanced, by_range = frame.persist, lakes.balanced, frame.repartitionByRange
    monkeypatch.setattr(detector, "IN_PLACE_ROWS", 50, raising=False)
    monkeypatch.setattr(frame, "persist", lambda df, level=StorageLevel.MEMORY_AND_DISK_DESER: on_disk.append(level.useDisk) or persist(df, level))
    monkeypatch.setattr(lakes, "balanced", lambda rows, *by: hinted.extend(by) or balanced(rows, *by))
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, *by: ranged.append(by) or by_range(df, *by))
    got = QUERIES["m07_cold_start"](spark, small_files).collect()
    assert [(r["proto"], r["n"]) for r in got] == [("tcp", ROWS)]
    assert on_disk and not any(on_disk) and not ranged and "ingest_date" not in hinted


def test_batch_written_in_place_replaces_itself(spark, folder):
    rows = spark.range(0, 60, 1, 3).select("id", (F.col("id") % 5).cast("int").alias("d"))
    write_batch(rows, folder, "d", 1, in_place=True)
    write_batch(rows.where("d < 2"), folder, "d", 2, in_place=True)
    write_batch(rows.where("d = 3"), folder, "d", 1, in_place=True)
    back = spark.read.parquet(folder).groupBy("batch_id", "d").count().collect()
    assert sorted(map(tuple, back)) == [(1, 3, 12), (2, 0, 12), (2, 1, 12)]


def test_written_in_place(spark, folder):
    rows = spark.range(0, 400, 1, 2).select("id", (F.col("id") % 100).cast("int").alias("d"))
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    write_in_place(rows, folder, "d")
    assert spark.conf.get(setting) == before
    back = spark.read.parquet(folder)
    assert sorted(map(tuple, back.select("id", "d").collect())) == [(n, n % 100) for n in range(400)]


def test_ranks_are_plain_comparisons(spark):
    rows = spark.range(100).select("id", (F.col("id") * 37 % 100).alias("a"))
    assert "lambda" not in plan_of(U.sorted_by_all(rows, [F.col("id"), F.col("a")], 4)).lower()

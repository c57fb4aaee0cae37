"""Physical plans: what reaches the scan, what is shuffled, what is copied."""

import datetime as dt
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loghaven.lake import new_folder, write_partitioned
from loghaven.operators import intel as I
from loghaven.operators import rules as R
from loghaven.operators.anomaly import score_scaled
from loghaven.operators.features import FEATURES, flow_features, scale_features
from loghaven.operators.logs import parse_logs, to_logs_parsed
from loghaven.plans import dashboards as D
from loghaven.plans import forensics as X

TS = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def flows(spark):
    folder = new_folder(spark, "flows")
    rows = spark.range(2000).select(
        F.timestamp_seconds(1704067200 + F.col("id") * 300).alias("ingest_ts"),
        F.concat(F.lit("10.0.0."), F.col("id") % 50).alias("src_ip"),
        F.concat(F.lit("8.8.8."), F.col("id") % 70).alias("dest_ip"),
        (F.col("id") % 90).cast("int").alias("dest_port"),
        (F.col("id") * 7).alias("orig_bytes"),
        (F.col("id") % 500).alias("resp_bytes"),
        (F.col("id") % 13 / 2).alias("duration"),
        F.lit("SF").alias("conn_state"),
        (F.col("id") % 10 == 0).alias("is_anomaly"),
    ).withColumn("ingest_date", F.to_date("ingest_ts"))
    write_partitioned(rows, folder, "ingest_date")
    return spark.read.parquet(folder)


@pytest.fixture(scope="module")
def logs(spark):
    folder = new_folder(spark, "logs")
    raw = spark.range(300).select(
        F.lit("web-logs").alias("source_topic"), F.lit(TS).alias("kafka_ts"),
        F.concat(
            F.when(F.col("id") % 9 == 0, "/../").otherwise("1.1.1.1"), F.lit(' - - [x] "GET /../ HTTP/1.1" 401 5')
        ).alias("raw_log"),
    )
    write_partitioned(to_logs_parsed(parse_logs(raw)), folder, "ingest_date")
    return spark.read.parquet(folder)


def test_lookup_prunes_partitions_pushes_filters_and_reads_few_columns(flows):
    plan = plan_of(X.pruned_lookup(flows, "2024-01-02", 22))
    assert re.search(r"PartitionFilters: \[.*ingest_date.* = ", plan)
    assert "EqualTo(dest_port,22)" in plan
    assert "duration" not in re.search(r"ReadSchema: \S+", plan).group()


def test_relative_time_also_prunes_dates(flows):
    plan = plan_of(X.anomaly_share(flows, F.lit(TS)))
    assert re.search(r"PartitionFilters: \[.*ingest_date.* >= ", plan)


def test_counts_read_only_their_key(logs):
    plan = plan_of(D.events_per_topic(logs))
    assert "ReadSchema: struct<source_topic:string>" in plan
    assert "partial_count" in plan


def test_top_k_is_no_full_sort(logs):
    assert "TakeOrderedAndProject" in plan_of(D.top_paths(logs))


def test_share_of_total_moves_no_rows_to_one_task(logs):
    plan = plan_of(D.method_share(logs))
    assert "windowspecdefinition" not in plan and "Subquery" in plan


def test_rules_scan_once_and_combine_before_the_shuffle(logs):
    plan = plan_of(R.rule_hits(logs))
    assert plan.count("FileScan") == 1
    assert "partial_count" in plan and "BatchEvalPython" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_located_alerts_count_the_rules_once(logs):
    alerts = R.evaluate_rules(logs)
    alerts.collect()
    final = plan_of(alerts).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    # One scan for the rules, one of the addresses alone for the lookup.
    assert final.count("FileScan") == 2


def test_small_indicators_are_broadcast_and_large_ones_salted(spark, flows):
    listed = spark.createDataFrame([("10.0.0.1",)], "src_ip string")
    assert "BroadcastHashJoin" in plan_of(I.match_indicators(flows, listed, "src_ip"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(I.match_indicators(flows, listed, "src_ip", max_rows=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_bloom_filter_precedes_the_shuffled_join(spark, flows):
    listed = spark.createDataFrame([(f"10.0.0.{i}", i) for i in range(50)], "src_ip string, n int")
    path = new_folder(spark, "listed")
    listed.write.parquet(path)
    listed = spark.read.parquet(path).filter("n < 3")
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = I.match_indicators_shuffled(flows, listed, "src_ip")
        plan, n = plan_of(joined), joined.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan and "SortMergeJoin" in plan
    assert n == flows.filter("src_ip IN ('10.0.0.0', '10.0.0.1', '10.0.0.2')").count()


def test_bucketed_join_has_no_exchange_and_spreads_the_hot_key(spark):
    hot = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 30)).alias("ip"), "id")
    small = spark.createDataFrame([("hot", 1), ("k1", 2)], "ip string, tag int")
    I.write_bucketed(hot, "bucketed_big", "ip", 8, 4, path=new_folder(spark, "big"))
    I.write_bucketed(small, "bucketed_small", "ip", 8, 4, replicated=True, path=new_folder(spark, "small"))
    big = spark.table("bucketed_big")
    joined = I.join_bucketed(big, spark.table("bucketed_small"), "ip")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == hot.join(small, "ip").count()
    assert big.filter("ip = 'hot'").select("_salt").distinct().count() == 4


def test_scoring_has_no_python_and_survives_a_filter(spark, flows):
    scaled = scale_features(flow_features(flows))
    centers = [[float(i)] * 5 for i in range(8)]
    found = score_scaled(scaled, [F.col(f"z_{f}") for f in FEATURES], centers).filter("is_anomaly")
    plan = plan_of(found)
    assert "Python" not in plan
    # Behind the generator the filter cannot copy the logarithms.
    assert plan.count("LOG1P") <= 2 * 3
    assert found.count() >= 0


def test_parse_binds_json_once(spark):
    raw = spark.createDataFrame([("t", TS, "{}")], "source_topic string, kafka_ts timestamp, raw_log string")
    plan = plan_of(parse_logs(raw).filter("country = 'Internal' AND status_code = '200'"))
    assert plan.count("from_json") == 1 and "Python" not in plan

"""Flow parsing, features, scaling, scoring and the model."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loghaven.functions.net import ipv4_number, is_private
from loghaven.operators import anomaly as M
from loghaven.operators import features as P
from loghaven.operators.flows import parse_flows, parse_flows_typed, to_network_flows, valid_flows
from loghaven.schemas import NETWORK_FLOWS

TS = dt.datetime(2024, 5, 6, 7, 8, 9)


def records(spark, *lines):
    return spark.createDataFrame([(TS, x) for x in lines], "kafka_ts timestamp, raw_log string")


def test_numbers_as_numbers_and_as_text(spark):
    a = '{"ts":1.5,"uid":"u","id.orig_h":"1.1.1.1","id.orig_p":5,"id.resp_h":"2.2.2.2","id.resp_p":80,"duration":0.5,"orig_bytes":7,"resp_bytes":8,"is_attack":true}'
    b = '{"ts":"1.5","uid":"u","id.orig_h":"1.1.1.1","id.orig_p":"5","id.resp_h":"2.2.2.2","id.resp_p":"80","duration":"0.5","orig_bytes":"7","resp_bytes":"8","is_attack":true}'
    x, y = parse_flows(records(spark, a, b)).collect()
    assert x == y
    assert (x.ts, x.src_port, x.dest_port, x.duration, x.orig_bytes, x.is_attack) == (1.5, 5, 80, 0.5, 7, True)
    assert x.event_time == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)


def test_iso_time_and_bad_values(spark):
    r = parse_flows(records(spark, '{"ts":"2024-05-06T07:08:09","orig_bytes":"-","id.resp_p":"x"}')).first()
    assert r.event_time == TS and r.ts is None and r.orig_bytes is None and r.dest_port is None


def test_validity(spark):
    rows = [("a", "b", 1), ("", "b", 1), ("-", "b", 1), (None, "b", 1), ("a", None, 1), ("a", "b", None)]
    df = spark.createDataFrame(rows, "src_ip string, dest_ip string, dest_port int")
    assert valid_flows(df).collect() == [("a", "b", 1)]


def test_typed_reading_drops_incomplete_rows(spark):
    full = '{"id.resp_p":80,"duration":0.5,"orig_bytes":7,"resp_bytes":8,"id.orig_h":"1.1.1.1"}'
    got = parse_flows_typed(records(spark, full, full.replace('"duration":0.5,', ""), "junk")).collect()
    assert len(got) == 1 and got[0].dest_port == 80


def test_features(spark):
    df = spark.createDataFrame(
        [("192.168.1.250", "172.16.0.1", None, None, 5), ("1.1.1.1", "172.32.0.1", 1.0, 2, None)],
        "src_ip string, dest_ip string, duration double, orig_bytes bigint, resp_bytes bigint",
    )
    a, b = P.flow_features(df).collect()
    assert (a.duration_log, a.orig_bytes_log, a.is_dst_external, a.is_src_server) == (0.0, 0.0, 0, 1)
    assert b.orig_bytes_log == pytest.approx(math.log(3)) and (b.is_dst_external, b.is_src_server) == (1, 0)


@pytest.mark.parametrize(
    "ip, private",
    [("10.0.0.1", True), ("192.168.9.9", True), ("172.16.0.1", True), ("172.31.0.1", True), ("172.32.0.1", False),
     ("172.1.0.1", False), ("192.169.0.1", False), ("11.0.0.1", False)],
)
def test_private_addresses(spark, ip, private):
    assert spark.range(1).select(is_private(F.lit(ip)).alias("r")).first().r is private


@pytest.mark.parametrize(
    "ip, n", [("0.0.0.1", 1), ("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("a.b.c.d", None), ("1.2.3", None)]
)
def test_ipv4_number(spark, ip, n):
    assert spark.createDataFrame([(ip,)], "ip string").select(ipv4_number(F.col("ip")).alias("r")).first().r == n


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = P.scale_features(df, ("a", "b")).orderBy("a").collect()
    assert [r.z_b for r in got] == [0.0, 0.0]
    assert got[0].z_a == pytest.approx(-math.sqrt(0.5))


def test_server_flags_from_table(spark):
    flows = spark.createDataFrame([("a",), ("b",), ("b",)], "src_ip string")
    servers = spark.createDataFrame([("b",), ("b",)], "src_ip string")
    assert sorted(P.flag_servers(flows, servers).collect()) == [("a", 0), ("b", 1), ("b", 1)]


def points(spark):
    return spark.createDataFrame([(0.0, 0.0), (3.0, 4.0), (9.0, 9.0)], "x double, y double")


def score(spark, centers, threshold=3.0):
    return M.score_scaled(points(spark), [F.col("x"), F.col("y")], centers, threshold).orderBy("x").collect()


def test_score_and_strict_threshold(spark):
    got = score(spark, [(0.0, 0.0), (9.0, 9.0)], threshold=5.0)
    assert [(r.cluster_id, r.anomaly_score, r.is_anomaly) for r in got] == [(0, 0.0, False), (0, 5.0, False), (1, 0.0, False)]
    assert score(spark, [(0.0, 0.0)], threshold=4.99)[1].is_anomaly


def test_tie_goes_to_the_lowest_center(spark):
    assert score(spark, [(5.0, 5.0), (0.0, 0.0), (0.0, 0.0)])[0].cluster_id == 1


def test_both_forms_of_scoring_agree(spark, monkeypatch):
    centers = [(float(i), float(7 * i % 5)) for i in range(6)]
    plain = score(spark, centers)
    monkeypatch.setattr(M, "UNROLLED_TERMS", 0)
    assert score(spark, centers) == plain


def flows(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("u"), "id").alias("uid"),
        F.when(F.col("id") % 3 == 0, "10.0.0.1").otherwise("8.8.8.8").alias("src_ip"),
        F.when(F.col("id") % 2 == 0, "10.0.0.2").otherwise("9.9.9.9").alias("dest_ip"),
        (F.col("id") % 7 / 10).alias("duration"),
        (F.col("id") * 13 % 1000).alias("orig_bytes"),
        (F.col("id") * 7 % 500).alias("resp_bytes"),
        (F.col("id") % 100).cast("int").alias("dest_port"),
    )


def test_training_and_scoring_invariants(spark):
    df = P.flow_features(flows(spark))
    model = M.train(df, k=4)
    assert len(model.centers) == 4 and model.training_rows == 400 and model.wssse >= 0
    scored = M.score(df, model).cache()
    assert scored.filter("anomaly_score < 0 OR cluster_id IS NULL").count() == 0
    # The sum of squared distances to the nearest centers is the training cost.
    total = scored.agg(F.sum(F.col("anomaly_score").cast("double") ** 2)).first()[0]
    assert total == pytest.approx(model.wssse, rel=1e-4)
    sizes = {r.cluster_id: r["count"] for r in scored.groupBy("cluster_id").count().collect()}
    assert sum(sizes.values()) == 400


def test_rows_without_features_are_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 1.0)], "a double, b double")
    assert P.complete_rows(df, ("a", "b")).collect() == [(1.0, 2.0)]


def test_decay_update(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    got = M.update_with_decay(df, [F.col("x")], [(0.0,), (100.0,), (50.0,)], [2.0, 4.0, 0.0], 0.5).orderBy("cluster_id")
    assert [(r.weight, list(r.center)) for r in got.collect()] == [(3.0, [pytest.approx(4 / 3)]), (2.0, [100.0]), (0.0, [50.0])]


def test_decayed_model_moves_toward_new_data(spark):
    df = P.flow_features(flows(spark))
    model = M.train(df, k=3)
    moved = M.decayed_model(df, model, decay=1.0)
    assert moved.version == model.version + 1
    assert sum(moved.weights) == pytest.approx(2 * 400)


def test_refit_keeps_scaling_and_needs_enough_rows(spark):
    df = flows(spark)
    model = M.train(df, P.RAW_FEATURES, k=3)
    assert M.refit_centers(df, model, k=3, min_rows=1000) is model
    again = M.refit_centers(df, model, k=3)
    assert again.mean == model.mean and again.std == model.std and again.version == model.version + 1


def test_baseline_sample_is_stable(spark):
    df = flows(spark)
    first = [r.uid for r in M.baseline_sample(df, ["uid"], 10).collect()]
    assert first == [r.uid for r in M.baseline_sample(df.repartition(7), ["uid"], 10).collect()]


def test_confusion_and_recall(spark):
    rows = [("SCAN_1", True, True), ("SCAN_2", True, False), ("x", False, True), ("y", False, False), ("C2_1", True, True)]
    df = spark.createDataFrame(rows, "uid string, is_attack boolean, is_anomaly boolean")
    assert M.confusion(df).first().asDict() == {"tp": 2, "fp": 1, "fn": 1, "tn": 1, "precision": 0.6667, "recall": 0.6667}
    assert {r.attack_kind: r.recall for r in M.recall_by_kind(df).collect()} == {"SCAN": 0.5, "C2": 1.0}
    assert M.confusion(df.filter("false")).first().precision is None


def test_network_flows_projection(spark):
    line = '{"ts":1.5,"uid":"u","id.orig_h":"1.1.1.1","id.resp_h":"2.2.2.2","id.resp_p":80}'
    df = P.flow_features(parse_flows(records(spark, line)))
    model = M.ClusterModel(P.FEATURES, (0.0,) * 5, (1.0,) * 5, ((0.0,) * 5,))
    table = to_network_flows(M.score(df, model))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in NETWORK_FLOWS]
    assert table.first().ingest_date == TS.date()

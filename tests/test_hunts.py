"""Joins, address ranges, hunts and upkeep against brute force on small data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loghaven.lake import Lake, new_folder, scan, stored
from loghaven.operators import hunting as H
from loghaven.operators import intel as I
from loghaven.operators import maintenance as U
from loghaven.operators import netrange as N

TS = dt.datetime(2024, 5, 6)


def skewed(spark, n=300):
    """A third of the rows share one key."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("ip")
    )


@pytest.fixture
def listed(spark):
    return spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), (None, "d"), ("zz", "e")], "ip string, tag string")


@pytest.mark.parametrize("max_rows", [100, 0])
def test_indicator_joins(spark, listed, max_rows):
    df = skewed(spark)
    want = df.filter("ip IN ('hot', 'k1')").count()
    assert I.match_indicators(df, listed, "ip", max_rows).count() == want
    tagged = I.tag_indicators(df, listed, "ip", max_rows)
    assert tagged.count() == 300
    assert {r.tag for r in tagged.filter("ip = 'hot'").collect()} == {"a"}
    assert I.match_indicators_shuffled(df, listed, "ip").count() == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, listed, how):
    df = skewed(spark)
    plain = sorted(map(tuple, df.join(listed, "ip", how).collect()), key=str)
    assert sorted(map(tuple, I.salted_join(df, listed, "ip", how, 5).collect()), key=str) == plain


def test_sightings(spark):
    a = spark.createDataFrame([("x", TS), ("x", TS + dt.timedelta(1)), ("y", TS)], "ip string, t timestamp")
    b = spark.createDataFrame([("x", TS)], "src string, t timestamp")
    listed = spark.createDataFrame([("x",), ("x",)], "indicator string")
    for bound in (10, 0):
        got = I.sightings([("a", a, "ip", "t"), ("b", b, "src", "t")], listed, max_rows=bound).collect()
        assert sorted((r.source, r.first_seen, r.last_seen, r.sightings) for r in got) == [
            ("a", TS, TS + dt.timedelta(1), 2), ("b", TS, TS, 1),
        ]


CIDRS = [("0.0.0.0/0", "world"), ("10.0.0.0/8", "ten"), ("10.1.0.0/16", "ten-one"), ("10.1.2.0/24", "net"),
         ("10.1.2.3/32", "host"), ("200.0.0.0/7", "far"), ("junk", "x"), ("1.2.3.4/40", "y")]


@pytest.mark.parametrize("cidrs", [CIDRS, CIDRS[1:]])
@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_longest_prefix(spark, cidrs, max_rows):
    import ipaddress

    nets = []
    for c, label in cidrs:
        try:
            nets.append((ipaddress.ip_network(c), label))
        except ValueError:
            pass
    rnd = random.Random(7)
    ips = ["10.1.2.3", "10.1.2.4", "10.1.3.0", "10.0.255.255", "10.255.255.255", "9.255.255.255", "11.0.0.0",
           "201.255.255.255", "202.0.0.0", "0.0.0.0", "255.255.255.255"]
    ips += [".".join(str(rnd.randrange(256)) for _ in range(4)) for _ in range(50)]
    ranges = stored(N.disjoint_ranges(spark.createDataFrame(cidrs, "cidr string, area string"), "area"), "ranges")
    got = N.locate(spark.createDataFrame([(x,) for x in ips + ["bad"]], "ip string"), "ip", ranges, "area", "out", max_rows)
    for r in got.collect():
        fits = [] if r.ip == "bad" else [(n.prefixlen, label) for n, label in nets if ipaddress.ip_address(r.ip) in n]
        assert r.out == (max(fits)[1] if fits else None), r.ip
    assert got.count() == len(ips) + 1


def random_events(spark, n=400):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"u{rnd.randrange(8)}", rnd.choice("abc"),
             TS + dt.timedelta(seconds=rnd.randrange(20_000))) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "who string, kind string, at timestamp")


@pytest.mark.parametrize("within, slice_seconds", [(60, 3600), (600, 10), (600, 600), (7200, 1000)])
def test_followed_by(spark, within, slice_seconds):
    rows, df = random_events(spark)
    got = H.followed_by(df, "who", "at", F.col("kind") == "a", F.col("kind") == "b", within, slice_seconds).collect()
    want = []
    for who, kind, at in rows:
        if kind == "a":
            later = [t for w, k, t in rows if w == who and k == "b" and 0 < (t - at).total_seconds() <= within]
            if later:
                want.append((who, at, min(later)))
    assert sorted((r.who, r.first_at, r.then_at) for r in got) == sorted(want)


@pytest.mark.parametrize("slice_seconds", [10, 600, 10**6])
def test_gaps_do_not_depend_on_slices(spark, slice_seconds):
    rows, df = random_events(spark)
    want = []
    for who in {r[0] for r in rows}:
        times = sorted(t for w, _, t in rows if w == who)
        want += [(who, int((b - a).total_seconds() * 1e6)) for a, b in zip(times, times[1:])]
    got = H.arrival_gaps(df, ["who"], "at", slice_seconds).collect()
    assert sorted((r.who, r.gap) for r in got) == sorted(want)


def test_beacon_is_found_among_noise(spark):
    beacon = [("10.10.5.100", "185.220.101.42", 4444, TS + dt.timedelta(seconds=60 * i), 150) for i in range(100)]
    rnd = random.Random(1)
    noise = [("1.1.1.1", "2.2.2.2", 80, TS + dt.timedelta(seconds=rnd.randrange(6000)), 150) for _ in range(100)]
    big = [("3.3.3.3", "2.2.2.2", 80, TS + dt.timedelta(seconds=60 * i), 10**6) for i in range(100)]
    df = spark.createDataFrame(beacon + noise + big, "src_ip string, dest_ip string, dest_port int, event_time timestamp, orig_bytes bigint")
    r, = H.beacons(df).collect()
    assert (r.src_ip, r.events, r.mean_gap_sec, r.variation) == ("10.10.5.100", 100, 60.0, 0.0)


def test_flood(spark):
    rows = [(f"1.1.{i // 200}.{i % 200}", "10.0.0.1", TS) for i in range(150)] + [("9.9.9.9", "10.0.0.2", TS)] * 500
    df = spark.createDataFrame(rows, "src_ip string, dest_ip string, at timestamp")
    assert H.floods(df, "at").collect() == [(TS, "10.0.0.1", 150, 150)]


def test_sliding_counts(spark):
    rows, df = random_events(spark)
    got = {(r.window_start, r.who): r.n for r in H.sliding_counts(df, "at", ["who"]).collect()}
    direct = df.groupBy(F.window("at", "5 minutes", "1 minute").alias("w"), "who").count()
    assert got == {(r.w.start, r.who): r["count"] for r in direct.collect()}


def test_deduplicate_keeps_one_whole_row(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, x string, y int")
    assert sorted(H.deduplicate(df, ["k"]).collect()) == [(1, "a", 9), (2, "c", 1)]


def test_interval_join(spark):
    left = spark.createDataFrame([("u", TS)], "who string, a timestamp")
    right = spark.createDataFrame([("u", TS + dt.timedelta(minutes=m)) for m in (-1, 0, 5, 6)] + [("v", TS)], "who string, b timestamp")
    got = I.interval_join(left, right, "who", "a", "b", "5 MINUTES").collect()
    assert sorted(r.b for r in got) == [TS, TS + dt.timedelta(minutes=5)]


def partitioned(spark, folder):
    df = spark.range(500).select(
        F.col("id"), (F.col("id") % 50).alias("v"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"),
    )
    df.repartition(20).write.partitionBy("d").parquet(folder)
    return df


def test_compaction_keeps_content_and_merges_files(spark, folder):
    df = partitioned(spark, folder)
    before = U.fingerprint(df).first()
    stats = {str(r.d): r.files for r in U.file_stats(spark, folder, "d").collect()}
    assert stats["2024-01-02"] > 1
    assert U.compact(spark, folder, "d", "2024-01-02", new_folder(spark, "staging"), by=("v",)) == 1
    spark.catalog.refreshByPath(folder)
    assert U.fingerprint(spark.read.parquet(folder).select(*df.columns)).first() == before
    after = {str(r.d): r.files for r in U.file_stats(spark, folder, "d").collect()}
    assert after == {**stats, "2024-01-02": 1}
    assert U.compact(spark, folder, "d", "2030-01-01", new_folder(spark, "staging")) == 0


def test_sorting_spreads_one_hot_value(spark):
    df = spark.range(1000).select(F.lit(1).alias("v"), "id")
    parts = U.sorted_for_pruning(df, ("v",), 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 500


def test_retention(spark, folder):
    partitioned(spark, folder).write.partitionBy("d").option("path", folder + "-t").saveAsTable("expiring")
    assert U.expire(spark, "expiring", "d", 2, "2024-01-05") == ["2024-01-01", "2024-01-02"]
    assert U.expire(spark, "expiring", "d", 2, "2024-01-05") == []
    assert scan(spark, "expiring").count() == 300
    assert scan(spark, "expiring", 7).count() == 7


def test_managed_lake_bootstrap_and_append(spark):
    lake = Lake(database="boot")
    lake.create_tables(spark)
    row = spark.createDataFrame([(1, 2, TS, 0.5, 1.5, 3)], "batch_id bigint, training_id bigint, ingest_ts timestamp, wssse double, training_duration_sec double, training_rows bigint")
    lake.append(row, "model_metrics")
    lake.create_tables(spark)
    got = spark.table("boot.model_metrics").first()
    assert (got.training_id, got.batch_id) == (2, 1)
    assert spark.table("boot.alerts").count() == 0


def test_path_lake_is_visible_in_the_catalog_after_sync(spark, folder):
    lake = Lake(database="pathy", location=folder)
    lake.create_tables(spark)
    row = spark.createDataFrame([(5, 2, TS, 0.5, 1.5, 3)], "batch_id bigint, training_id bigint, ingest_ts timestamp, wssse double, training_duration_sec double, training_rows bigint")
    lake.write_batch(row, "model_metrics", None)
    lake.sync(spark, "model_metrics")
    assert spark.table("pathy.model_metrics").select("batch_id", "training_id").collect() == [(5, 2)]


def test_batches_are_registered_and_replaced_in_the_catalog(spark, folder):
    lake = Lake(database="regis", location=folder)
    lake.create_tables(spark)
    schema = "batch_id bigint, training_id bigint, ingest_ts timestamp, wssse double, training_duration_sec double, training_rows bigint"
    rows = spark.createDataFrame([(5, 2, TS, 0.5, 1.5, 3), (6, 3, TS, 0.5, 1.5, 3)], schema)
    lake.write_batch(rows, "model_metrics", None, (5, 6))
    table = lambda: sorted(spark.table("regis.model_metrics").select("batch_id", "training_id").collect())
    assert table() == [(5, 2), (6, 3)]
    lake.write_batch(rows.filter("batch_id = 9"), "model_metrics", None, (6,))
    assert table() == [(5, 2)]


def test_compaction_folds_closed_batches(spark, folder):
    df = spark.range(300).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"), (F.col("id") % 4).alias("batch_id"))
    df.repartition(6).write.partitionBy("d", "batch_id").parquet(folder)
    content = lambda: U.fingerprint(spark.read.parquet(folder).select("id", "d")).first()
    before = content()
    assert U.compact(spark, folder, "d", "2024-01-02", new_folder(spark, "staging"), closed_batch=2) == 1
    spark.catalog.refreshByPath(folder)
    assert content() == before
    rows = spark.read.parquet(folder).filter("d = DATE'2024-01-02'").groupBy("batch_id").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 75), (3, 25)]
    assert U.compact(spark, folder, "d", "2024-01-03", new_folder(spark, "staging")) == 1
    spark.catalog.refreshByPath(folder)
    assert content() == before


def test_width_must_be_a_multiple_of_the_slide(spark):
    df = spark.createDataFrame([(1, TS)], "k int, at timestamp")
    with pytest.raises(ValueError):
        H.sliding_counts(df, "at", ["k"], "5 minutes", "2 minutes")


def test_beacons_keep_keys_with_null_parts(spark):
    rows = [(None, "b", TS + dt.timedelta(minutes=i), 10) for i in range(30)]
    df = spark.createDataFrame(rows, "src_ip string, dest_ip string, event_time timestamp, orig_bytes long")
    assert H.beacons(df, key=("src_ip", "dest_ip")).count() == H.beacons(df, key=("src_ip", "dest_ip"), max_bytes=None).count() == 1


def test_equal_rows_of_a_hot_key_get_different_salts(spark):
    df = spark.range(1000).select(F.lit("a").alias("k")).repartition(1)
    assert I.spread(df, 8).select("_salt").distinct().count() == 8


def test_interval_join_of_a_hot_key_by_buckets(spark):
    times = [TS + dt.timedelta(seconds=37 * i) for i in range(200)]
    left = spark.createDataFrame([("u", t) for t in times[::3]], "who string, a timestamp")
    right = spark.createDataFrame([("u", t) for t in times], "who string, b timestamp")
    got = sorted((r.a, r.b) for r in I.interval_join(left, right, "who", "a", "b", "5 MINUTES").collect())
    assert got == sorted((a, b) for a in times[::3] for b in times if a <= b <= a + dt.timedelta(minutes=5))


def test_private_addresses_by_range(spark):
    from loghaven.functions import net

    ips = ["10.0.0.1", "172.16.0.1", "172.31.255.255", "172.200.1.1", "172.160.0.1", "192.168.3.4", "8.8.8.8", "x", None]
    rows = spark.createDataFrame([(i,) for i in ips], "ip string").select(net.is_private_address(F.col("ip")), net.is_private(F.col("ip"))).collect()
    assert [r[0] for r in rows] == [True, True, True, False, False, True, False, None, None]
    assert [r[1] for r in rows][:5] == [True] * 5

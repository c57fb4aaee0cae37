"""Mergeable moments, sketches, streamed sequences, prefix lookup, layout by two columns, readable state."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from loghaven.functions.net import ipv4_number
from loghaven.operators import hunting as H
from loghaven.operators import maintenance as U
from loghaven.operators import netrange as N
from loghaven.operators import sketches as S
from loghaven.streaming import windows
from loghaven.streaming.beacons import BeaconState

START = dt.datetime(2024, 5, 6, 7)
ALL = {"availableNow": True}


def contacts(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        rows.append((rng.choice(["a", "b", None]), START + dt.timedelta(seconds=i * 31 + rng.random()), rng.choice([None, 5, 500])))
    rows += [("hot", START + dt.timedelta(seconds=20 * i), 10) for i in range(n)] + [("one", START, 1), ("late", None, 7)]
    return spark.createDataFrame(rows, "ip string, at timestamp, size long"), rows


def by_hand(rows):
    out = {}
    for ip in {r[0] for r in rows}:
        times = sorted(t.timestamp() for k, t, _ in rows if k == ip and t is not None)
        gaps = [b - a for a, b in zip(times, times[1:])]
        sizes = [s for k, _, s in rows if k == ip and s is not None]
        mean = statistics.mean(gaps) if gaps else None
        out[ip] = (len(times), len(gaps), mean, sum((g - mean) ** 2 for g in gaps) if gaps else 0.0, len(sizes), sum(sizes))
    return out


def close(state, rows):
    want = by_hand(rows)
    assert {r.ip for r in state} == set(want)
    for r in state:
        events, gaps, mean, m2, sized, size = want[r.ip]
        assert (r.events, r.gaps, r.sized, r.size or 0) == (events, gaps, sized, size)
        assert r.mean_gap == pytest.approx(mean, rel=1e-6) if gaps else r.mean_gap is None
        assert r.m2 == pytest.approx(m2, rel=1e-6, abs=1e-6)


def test_moments_of_one_pass(spark):
    events, rows = contacts(spark)
    close(H.gap_moments(events, ["ip"], "at", 60, "size").collect(), rows)


def test_moments_of_three_batches_are_those_of_one(spark, folder):
    events, rows = contacts(spark)
    state = BeaconState(folder, ("ip",), "at", "size")
    cuts = [START + dt.timedelta(seconds=s) for s in (0, 3000, 7000, 10**6)]
    for i in range(3):
        part = (F.col("at") >= F.lit(cuts[i])) & (F.col("at") < F.lit(cuts[i + 1])) | (F.lit(i == 0) & F.col("at").isNull())
        state.process(events.where(part), i)
    state.process(events.where("false"), 3)
    close(state.state(spark).collect(), rows)
    before = sorted(map(str, state.state(spark).collect()))
    state.process(events.where("at < TIMESTAMP'2024-05-06 07:10:00' AND ip = 'hot'"), 4)  # all of them late
    after = state.state(spark).collect()
    assert {r.ip: r.late for r in after if r.late} == {"hot": 30}
    close(after, rows)
    state.process(events.where("false"), 3)  # replayed
    assert sorted(map(str, state.state(spark, before=4).collect())) == before


def test_sketches_merge_over_batches_and_days(spark, folder):
    rows = spark.range(20_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 20).alias("at"), (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 5003).alias("v")
    )
    table = S.SketchTable(folder, "at", ("k",), "v")
    for batch in range(3):
        table.add(rows.where(F.pmod(F.xxhash64("v", "at"), F.lit(3)) == batch), batch)
    table.add(rows.where(F.pmod(F.xxhash64("v", "at"), F.lit(3)) == 1), 1)  # replayed
    exact = {r.k: (r.d, r.n) for r in rows.groupBy("k").agg(F.count_distinct("v").alias("d"), F.count("*").alias("n")).collect()}
    for r in table.estimate(spark).collect():
        assert r.n == exact[r.k][1] and abs(r.distinct - exact[r.k][0]) <= S.ERROR * exact[r.k][0]
    whole = table.estimate(spark, ()).first()
    assert whole.n == 20_000 and abs(whole.distinct - 5003) <= S.ERROR * 5003
    none = table.estimate(spark, (), start="2030-01-01").first()
    assert (none.n, none.distinct) == (0, 0)
    assert S.port_scanners(table.read(spark), "k", "2023-11-14", "2023-11-20", 3000).count() == 3


def test_sequences_on_a_stream(spark, folder):
    schema = "who string, at timestamp, kind string"
    at = lambda m: START + dt.timedelta(minutes=m)
    steps = [
        [("a", at(0), "in"), ("a", at(5), "out"), ("a", at(7), "out"), ("b", at(1), "in"), ("b", at(0), "out"), ("c", at(2), "in"), (None, at(3), "in")],
        [("b", at(20), "out"), ("c", at(40), "out"), ("z", at(300), "other")],
        [("z", at(400), "in"), ("z", at(401), "other"), ("z", at(600), "out")],
    ]
    for step in steps:
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        events = spark.readStream.schema(schema).parquet(f"{folder}/in")
        stream = H.followed_by_stream(events, "who", "at", F.col("kind") == "in", F.col("kind") == "out", "30 MINUTES", "10 minutes")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(**ALL).start()
        query.awaitTermination()
    got = sorted((r.who, r.first_at, r.then_at) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [("a", at(0), at(5)), ("b", at(1), at(20))]
    rows = spark.read.parquet(f"{folder}/in")
    batch = H.followed_by(rows, "who", "at", F.col("kind") == "in", F.col("kind") == "out", 1800)
    assert sorted((r.who, r.first_at, r.then_at) for r in batch.collect()) == got


def test_prefix_keys_cover_each_address_once(spark):
    rng = random.Random(2)
    borders = sorted({0, 1 << 32, *(rng.randrange(1 << 32) for _ in range(40)), 1 << 24, (1 << 24) + 1, 5 << 16, (5 << 16) + 255})
    ranges = [(a, b - 1, f"r{a}") for a, b in zip(borders, borders[1:])]
    table = spark.createDataFrame(ranges, "first_address long, last_address long, area string")
    keys = N.prefix_keys(table, "area").collect()
    sizes = {}
    for k in keys:
        sizes[k.area] = sizes.get(k.area, 0) + (1 << k._level)
    assert sizes == {name: b - a + 1 for a, b, name in ranges}
    assert len({(k._level, k._prefix) for k in keys}) == len(keys)
    cidr = spark.createDataFrame([("10.0.0.0/25", "x"), ("10.1.0.0/9", "y")], "cidr string, area string")
    assert N.prefix_keys(N.disjoint_ranges(cidr, "area"), "area").groupBy("area").count().agg(F.max("count")).first()[0] <= 600


def test_files_by_two_columns(spark, folder):
    rows = spark.range(8000).select(F.col("id").alias("t"), (F.col("id") * 7919 % 8000).alias("a"), F.lit(None).cast("int").alias("none"))
    touched = {}
    for name, table in (("one", U.sorted_for_pruning(rows, ["t"], 16)), ("two", U.sorted_by_all(rows, [F.col("t"), F.col("a")], 16))):
        table.write.parquet(f"{folder}/{name}")
        files = spark.read.parquet(f"{folder}/{name}").groupBy(F.input_file_name()).agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.count("*").alias("n"))
        touched[name] = files.agg(F.count_if((F.col("a0") <= 4321) & (F.col("a1") >= 4321)), F.sum("n"), F.max("n")).first()
    assert touched["two"][0] * 2 <= touched["one"][0] and touched["one"][1] == touched["two"][1] == 8000
    assert touched["two"][2] < 2000
    assert U.sorted_by_all(rows.limit(0), [F.col("t"), F.col("none")], 4).count() == 0
    assert ipv4_number is not None


def test_open_windows_are_read_from_the_state(spark, folder):
    schema = "user string, ts timestamp"
    rows = [("a", START), ("a", START), ("b", START + dt.timedelta(hours=1)), ("b", START + dt.timedelta(hours=1, minutes=6))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in")
    stream = H.tumbling_counts(spark.readStream.schema(schema).parquet(f"{folder}/in"), "ts", ["user"], watermark="10 minutes")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(**ALL).start()
    query.awaitTermination()
    given = [(r.user, r.n) for r in spark.read.parquet(f"{folder}/out").collect()]
    held = sorted((r.window_start, r.user, r.n) for r in windows.open_windows(spark, f"{folder}/cp").collect())
    assert given == [("a", 2)]
    assert held == [(START + dt.timedelta(hours=1), "b", 1), (START + dt.timedelta(hours=1, minutes=5), "b", 1)]

"""Hot keys by sketch, the bitmap prefilter, and lists that change under a stream."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from loghaven.operators import intel as I
from loghaven.streaming.hunts import IndicatorHunt

from conftest import plan_of


def hot_table(spark, n=6000):
    """A third of the rows have one key, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    return spark.range(n).select(key.alias("ip"), "id")


def listed_table(spark):
    rows = [("hot", 1), ("hot", 2), ("k5", 3), (None, 4), ("unseen", 5), ("", 6)]
    return spark.createDataFrame(rows, "ip string, why int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_is_the_plain_join(spark, how):
    big, small = hot_table(spark), listed_table(spark)
    got = I.hot_key_join(big, small, "ip", how, parts=16)
    want = big.join(small, "ip", how)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))
    assert "rand(" not in plan_of(got)
    assert Counter(map(tuple, I.hot_key_join(big.limit(0), small, "ip", how).collect())) == Counter()


def test_a_third_of_the_rows_goes_over_several_tasks(spark):
    big = hot_table(spark)
    hot = I.hot_keys(big, "ip", 16)
    assert list(hot) == ["hot"] and 5 <= hot["hot"] <= 8
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = I.hot_key_join(big, listed_table(spark).hint("merge"), "ip", hot=hot)
        tasks = Counter(r[0] for r in joined.where("ip = 'hot'").select(F.spark_partition_id()).collect())
        assert len(tasks) >= 3 and max(tasks.values()) < 0.6 * sum(tasks.values())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_salts_do_not_follow_the_order_of_rows(spark):
    big = hot_table(spark)
    salted = lambda rows: {tuple(r) for r in rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(7))).collect()}
    assert salted(big) == salted(big.orderBy(F.desc("id")).repartition(5))
    a, b = (I.hot_key_join(rows, listed_table(spark), "ip", parts=16) for rows in (big, big.repartition(3)))
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_beyond_the_bound_only_hot_keys_are_replicated(spark):
    big = hot_table(spark)
    assert I.hot_keys(spark.range(0).select(F.lit("a").alias("ip")), "ip") == {}
    even = spark.range(1000).select(F.col("id").cast("string").alias("ip"))
    assert I.hot_keys(even, "ip", 16) == {}
    assert I.match_indicators(big, listed_table(spark), "ip", max_rows=0).count() == I.match_indicators(big, listed_table(spark), "ip").count()


def test_bitmaps_lose_nothing_and_let_little_through(spark):
    events = spark.range(60_000).select(F.concat(F.lit("10."), F.col("id")).alias("ip"), "id")
    listed = events.where("id % 9 = 0").select("ip")
    found, through = I.match_indicators_prefiltered(events, listed, "ip")
    assert I.key_bitmaps(listed, "ip")[1] == 4
    ids = {r.id for r in through.collect()}
    assert ids >= {*range(0, 60_000, 9)} and len(ids) < 6667 + 600
    assert found.count() == 6667
    empty, none = I.match_indicators_prefiltered(events, listed.limit(0), "ip")
    assert empty.count() == none.count() == 0
    odd = spark.createDataFrame([(None,), ("",), ("10.9",), ("10.9",)], "ip string")
    assert [r.ip for r in I.match_indicators_prefiltered(odd, odd, "ip", max_rows=0)[0].collect()] == ["10.9", "10.9"]


def test_a_replayed_batch_meets_the_list_that_it_met(spark, folder):
    lists = [["a"], ["a", "b"], ["b"]]
    hunt = IndicatorHunt(f"{folder}/found", lambda s: s.createDataFrame([(x,) for x in lists[0]], "ip string"), "ip")
    batch = spark.createDataFrame([("a",), ("b",), ("c",)], "ip string")
    assert hunt.read(spark, batch.schema).count() == 0
    seen = lambda: sorted((r.batch_id, r.ip) for r in spark.read.parquet(f"{folder}/found").collect())
    hunt.process(batch, 0)
    assert seen() == [(0, "a")]
    lists.pop(0)
    hunt.process(batch, 1)
    assert seen() == [(0, "a"), (1, "a"), (1, "b")]
    lists.pop(0)
    hunt.process(batch, 1)
    assert seen() == [(0, "a"), (1, "a"), (1, "b")]

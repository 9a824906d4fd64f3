"""Joins over time against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import temporal

BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else BASE + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("partitions", [1, 7])
def test_as_of_equals_loop(spark, partitions):
    rng = random.Random(4)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", "d", None])
    moment = lambda: None if rng.random() < 0.03 else rng.randrange(400)
    versions = [(key(), at(moment()), n, f"v{n}") for n in range(300)]
    lookups = [(n, key(), at(moment()), "x") for n in range(500)] + [(500, "nobody", at(3), "x")]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        left = spark.createDataFrame(lookups, "n long, key string, time timestamp, version string").withColumnRenamed("version", "kind")
        right = spark.createDataFrame(versions, "key string, time timestamp, tie long, name string")
        got = {r.n: r.version and r.version.name for r in temporal.as_of(left, right, "key", "time", "tie").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = {}
    for n, k, t, _ in lookups:
        old = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and v[1] <= t]
        expected[n] = max(old, key=lambda v: (v[1], v[2]))[3] if old else None
    assert got == expected


def test_as_of_splits_a_hot_key(spark):
    # Tiny partitions would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        lookups = spark.range(4000).select(F.col("id").alias("n"), F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") + 10).alias("t"))
        versions = spark.createDataFrame([("hot", 1, at(-10**9)), ("hot", 2, at(-10**9))], "k string, o int, t timestamp")
        versions = versions.withColumn("t", F.timestamp_seconds(F.lit(5)))
        got = temporal.as_of(lookups, versions, "k", "t", "o")
        assert got.select("version.o").distinct().collect()[0].o == 2 and got.count() == 4000
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_as_of_empty_sides(spark):
    none = spark.createDataFrame([], "k string, o int, t timestamp")
    one = spark.createDataFrame([("a", 1, at(1))], "k string, o int, t timestamp")
    assert temporal.as_of(none, one, "k", "t", "o").count() == 0
    assert [r.version for r in temporal.as_of(one, none, "k", "t", "o").collect()] == [None]


def test_periods_equal_loop(spark):
    rng = random.Random(9)
    periods = [(n, at(a := rng.randrange(-500, 5000)), at(a + rng.choice([0, 1, 59, 60, 61, 600, 4000, -5]))) for n in range(150)]
    periods += [(900, None, at(5)), (901, at(0), None), (902, at(-10**7), at(10**8))]
    moments = [(n, at(rng.randrange(-600, 9000)) + dt.timedelta(microseconds=rng.choice([0, 1, 999_999]))) for n in range(300)]
    moments += [(1000, None)] + [(2000 + n, e) for n, (_, s, e) in enumerate(periods[:20])]
    left = spark.createDataFrame(moments, "m long, t timestamp")
    right = spark.createDataFrame(periods, "p long, s timestamp, e timestamp")
    joined = temporal.in_periods(left, right, "t", "s", "e")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan
    expected = sorted((m, p) for m, t in moments for p, s, e in periods if None not in (t, s, e) and s <= t < e)
    assert sorted((r.m, r.p) for r in joined.collect()) == expected
    assert temporal.in_periods(left, right.limit(0), "t", "s", "e").count() == 0


def test_period_totals_equal_loop(spark):
    rng = random.Random(5)
    tiny = lambda: dt.timedelta(microseconds=rng.choice([0, 0, 1, 7, 999_999]))
    periods = [(n, at(a := rng.randrange(-500, 5000)) + tiny(), at(a + rng.choice([0, 1, 59, 60, 61, 600, 4000, -5])) + tiny()) for n in range(150)]
    periods += [(900, None, at(5)), (901, at(0), None), (902, at(-10**7), at(10**8)), (None, at(0), at(3000)), (903, at(7), at(7) + dt.timedelta(microseconds=1))]
    moments = [(n % 200, at(rng.randrange(-600, 9000)) + tiny()) for n in range(300)]  # some keys twice
    moments += [(1000, None)] + [(2000 + n, e) for n, (_, s, e) in enumerate(periods)] + [(3000 + n, s) for n, (_, s, e) in enumerate(periods)]
    left = spark.createDataFrame(moments, "m long, t timestamp")
    right = spark.createDataFrame(periods, "p long, s timestamp, e timestamp")
    pairs = [(m, p) for m, t in moments for p, s, e in periods if None not in (t, s, e) and s <= t < e]
    expected = {}
    for m in {m for m, _ in pairs}:
        own = [p for n, p in pairs if n == m]
        numbers = [p for p in own if p is not None]
        expected[m] = (len(own), min(numbers, default=None), sum(numbers) if numbers else None)
    got = temporal.in_periods(left, right, "t", "s", "e", totals=("m", "p"))
    assert {r.m: (r.n, r.least, r.total) for r in got.collect()} == expected
    assert temporal.in_periods(left, right.limit(0), "t", "s", "e", totals=("m", "p")).count() == 0


def test_no_spread_side_is_sent_whole(spark):
    moments = spark.range(50).select("id", F.timestamp_seconds("id").alias("t"))
    periods = spark.range(50).select(F.col("id").alias("p"), F.timestamp_seconds("id").alias("s"), F.timestamp_seconds(F.col("id") + 500).alias("e"))
    for totals in (None, ("id", "p")):
        found = temporal.in_periods(moments, periods, "t", "s", "e", totals=totals)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

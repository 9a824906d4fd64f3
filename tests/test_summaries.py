"""Levels and sketches."""

from pyspark.sql import functions as F

from millrace.operators import summaries


def test_merge_equals_rebuild_and_keeps_its_bound(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 4).alias("run"), F.lit("k").alias("key"), (F.col("id") % 7001).cast("string").alias("item"), ((F.col("id") * 7919) % 10_007).alias("value")
    )
    parts = summaries.sketch(rows, ["key", "run"], "item", "value")
    read = lambda s: s.select("n", summaries.distinct().alias("d"), summaries.quantile(0.5).alias("m"), summaries.quantile(0.99).alias("t")).first()
    merged, rebuilt = read(summaries.merge(parts, ["key"])), read(summaries.sketch(rows, ["key"], "item", "value"))
    assert merged.n == rebuilt.n == 20_000
    for got in (merged, rebuilt):
        assert abs(got.d - 7001) < 0.07 * 7001
        assert abs(got.m / 10_007 - 0.5) < 0.04 and abs(got.t / 10_007 - 0.99) < 0.04
    assert abs(merged.d - rebuilt.d) <= 0.02 * rebuilt.d


def test_null_keys_are_not_totals(spark):
    frame = spark.createDataFrame([("a", None), ("a", "x"), (None, "x")], "p string, q string")
    got = {(r.p, r.q, r.level): r.n for r in summaries.count_levels(frame, ["p", "q"]).collect()}
    assert got[None, None, 3] == 3 and got["a", None, 0] == 1 and got["a", None, 1] == 2 and got[None, "x", 2] == 2
    chosen = summaries.count_levels(frame, ["p", "q"], [["q"], []])
    assert {(r.p, r.q, r.level): r.n for r in chosen.collect()} == {(None, "x", 2): 2, (None, None, 2): 1, (None, None, 3): 3}
    plan = summaries.count_levels(frame, ["p", "q"], [["q"], []])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

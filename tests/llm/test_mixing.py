"""Targets and taken words against a plain computation."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, quality, queries
from millrace.llm.common import running_before, word_count

SPACE = " \t\n\x0b\f\r"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, share, done = sum(sizes.values()), dict.fromkeys(names, 0.0), set()
    while True:
        open_ = [s for s in names if s not in done]
        total = sum(weight[s] for s in open_)
        if not open_ or not total:
            return share
        rest = left - sum(3.0 * sizes[s] for s in done)
        for s in open_:
            share[s] = rest * weight[s] / total
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return share
        for s in over:
            share[s] = 3.0 * sizes[s]
            done.add(s)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target string, n_chars long")


def words(t):
    return len([w for w in re.split(f"[{SPACE}]+", t or "") if w])


@pytest.mark.parametrize("parts", [1, 7])
def test_mix(spark, parts):
    rows = [(i, "w " * (i % 37) + " x", f"s{'ab' if i % 3 else i % 11}", 1, "t", 5) for i in range(900)]
    rows += [(i, "big " * 500, "zz", 1, "t", 5) for i in range(900, 905)] + [(5, None, None, 1, None, 5), (6, "a b c", None, 1, "", 5)]
    rows += [rows[4], rows[4], (None, " \n ", "zz", 0, "", 3), (1000, "tiny", "\U0001f600", 1, "", 4)]
    docs = table(spark, rows).repartition(parts)
    got = mixing.mix_sources(docs, keep=("doc_id", "source")).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + words(r[1])
    targets = plain_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in targets.items():
        assert t - 1 <= taken[s] <= t + 1e-6
    again = mixing.mix_sources(docs.repartition(3), keep=("doc_id", "source")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    out = mixing.repeat_taken(docs, mixing.mix_sources(docs))
    assert out.columns == docs.columns
    total = {}
    for r in out.collect():
        total[r.source] = total.get(r.source, 0) + words(r.text)
    repeated = {rows[4][2]}
    for s in sizes:
        if s not in repeated:
            assert total.get(s, 0) == taken[s]


def test_weights_matter(spark):
    docs = table(spark, [(i, "a b c d", "s", 1, "", 1) for i in range(400)] + [(i, "x y", "t", 1, "", 1) for i in range(400, 800)])
    got = mixing.mix_sources(docs, F.when(F.col("doc_id") % 2 == 0, 10.0).otherwise(0.1)).collect()
    part = [r for r in got if 0 < r.taken % r.size or r.source_size == 1600]
    even = sum(r.taken for r in part if r.doc_id % 2 == 0)
    assert even > 3 * sum(r.taken for r in part if r.doc_id % 2)


def test_scripts_and_scores(spark):
    latin, other = "some plain prose in a line", "\u4e2d\u6587 \u6587\u5b57 \u0639\u0631 \u0628\u064a \u0939\u093f \u0928\u0926"
    rows = [(i, (latin, other)[i % 2], "s", 1, "", 1) for i in range(400)]
    rows += [(i, "x y", "t", 1, "", 1) for i in range(400, 1600)]
    docs = table(spark, rows)
    part = lambda got: [sum(r.taken % r.size > 0 or r.taken > r.size * (r.target // r.source_size) for r in got if r.doc_id < 400 and r.doc_id % 2 == k) for k in (0, 1)]
    a, b = part(mixing.mix_sources(docs).collect())
    assert b > a / 2 > 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = quality.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    order = lambda df: sorted(map(tuple, df.select("doc_id", "taken").collect()))
    weighed = quality.score(docs, model, keep=tuple(docs.columns))
    wanted = order(mixing.mix_sources(weighed, F.col("quality_score")))
    assert order(queries.op4_source_mixing(spark, "/root/testdata/sf0.001")) == wanted
    assert wanted != order(mixing.mix_sources(docs))


def test_empty(spark):
    docs = table(spark, [])
    assert mixing.mix_sources(docs).count() == 0
    blank = table(spark, [(1, None, None, 1, "", 1), (2, "", "a", 1, "", 1)])
    assert {(r.size, r.target, r.taken) for r in mixing.mix_sources(blank).collect()} == {(0, 0.0, 0)}


def test_running_sums(spark):
    rows = [("a" if i % 3 else None, i, i * 2) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(5)
    for r in running_before(df, "g", ["o"], "v").collect():
        assert r.before == sum(v for g, o, v in rows if g == r.g and o < r.o)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\n", "a b c", "\x1c x", "é " * 1000, "a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [words(t) for t in texts]


def test_cut(spark):
    df = spark.createDataFrame([("  a b\n c", 2), ("a", 1), ("a b", 0), ("a\tb", 5)], "t string, n int")
    assert [r[0] for r in df.select(mixing.cut_words(F.col("t"), F.col("n"))).collect()] == ["  a b", "a", "", "a\tb"]


def test_equal_rows_share_what_is_taken(spark):
    """Four equal rows and others: what is handed out is what the mix holds, row by row."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "a", 10)] * 4 + [(2, "other words here", "a", 16), (3, "b " * 200, "b", 400), (4, None, "b", 0), (1, text, "b", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mixed = mixing.mix_sources(docs, None)
    expected = sum(r.taken for r in mixed.collect())
    out = mixing.repeat_taken(docs, mixed).collect()
    assert sum(len((r.text or "").split()) for r in out) == expected
    assert all(r.text in (x[1] for x in rows) or any((x[1] or "").startswith(r.text) for x in rows) for r in out)

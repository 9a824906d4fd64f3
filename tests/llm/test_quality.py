"""Held-out accuracy, and the tables against plain sums."""

import numpy as np
import pytest

from millrace.llm import quality

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r.quality_score for r in quality.score(docs, model).collect()}
    rows = [(got[i], q) for i, q in labels.items() if quality.is_held_out(i)]
    good, bad = sorted(s for s, q in rows if q == 1), sorted(s for s, q in rows if q == 0)
    better = np.searchsorted(np.array(bad), good, side="left").sum() / (len(good) * len(bad))
    print("auc", better, "kept good", np.mean(np.array(good) >= 0.3), "rejected bad", np.mean(np.array(bad) < 0.3))
    assert better > 0.97
    assert np.mean(np.array(good) >= 0.3) > 0.97
    assert np.mean(np.array(bad) < 0.3) > 0.85


def test_scores_are_sums(model):
    x = np.array([quality.features(t) for t in ("", "a", "The quick brown fox.", "A!! B!! C!!", "x " * 5000)])
    for row, found in zip(x, model.scores(x)):
        total = model.start + sum(t[np.searchsorted(e, v)] for e, t, v in zip(model.edges, model.tables, row))
        c = [int(np.searchsorted(e, v)) for e, v in zip(model.coarse, row)]
        total += sum(t[c[i], c[j]] for i, j, t in model.pairs)
        assert abs(1 / (1 + np.exp(-total)) - found) < 1e-12


def test_trees():
    rng = np.random.default_rng(1)
    g, h = rng.normal(size=10), rng.random(10) + 0.1
    out = quality.tree(g, h, 2)
    gain = lambda k: sum(g[s].sum() ** 2 / (h[s].sum() + quality.SMOOTH) for s in (slice(0, k), slice(k, None)))
    k = max(range(1, 10), key=gain)
    assert np.allclose(out[:k], g[:k].sum() / (h[:k].sum() + quality.SMOOTH))
    a, b = rng.normal(size=(4, 5)), rng.random((4, 5))
    best, table = quality.quarter(a, b)
    worth = lambda x, w: x.sum() ** 2 / (w.sum() + quality.SMOOTH)
    plain = {
        (i, j): sum(worth(a[r, c], b[r, c]) for r in (slice(0, i), slice(i, None)) for c in (slice(0, j), slice(j, None)))
        for i in range(1, 4) for j in range(1, 5)
    }
    assert abs(max(plain.values()) - worth(a, b) - best) < 1e-9
    assert len(np.unique(table)) == 4


def test_odd_tables(spark, model):
    docs = spark.createDataFrame(
        [(1, None, 0.5), (2, "", 0.5), (2, "", 0.5), (None, "a b", 0.1), (3, "x" * 300_000, 1.0)],
        "doc_id long, text string, quality_score double",
    )
    got = quality.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.quality_score <= 1 for r in got)
    assert quality.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (4, 1, 0)], "doc_id long, quality int, text int")
    empty = quality.train(docs, labels)
    assert {r.quality_score for r in quality.score(docs, empty).collect()} == {0.5}


def test_fold(spark):
    ids = spark.range(200).select("id", quality.held_out(__import__("pyspark").sql.functions.col("id")).alias("h"))
    assert all(r.h == quality.is_held_out(r.id) for r in ids.collect())

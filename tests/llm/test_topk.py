"""Branch and bound against a full scan."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import topk


def plain(rows, k):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in good if i % 20 == 0}:
        asked = {tuple(a) for i, a in good if i == q}
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for a in asked for i, b in good if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def check(spark, rows, k):
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(table, F.col("vec_id") % 20 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, k)


def test_random(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(700)]
    check(spark, rows, 20)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25]) for _ in range(40)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 360)]
    rows += [(400, None), (420, [None] * 40), (440, [float("nan")] * 40), (460, [float("inf")] * 40), (480, []), (481, [])]
    rows += [(500, [1.0, 2.0]), (501, [3.0, 4.0]), (20, rows[3][1]), (None, rows[3][1]), (41, [3e5] * 40), (60, [3e5] * 40)]
    check(spark, rows, 20)
    check(spark, rows, 3)


def test_many_blocks(spark, monkeypatch):
    """Seed floors, blocks that the norms rule out, ties at the floor."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(11)
    rows = [(i, (rng.normal(size=33) * (4 if i < 90 else 0.05)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[i % 5][1]) for i in range(120)] + [(600 + i, [0.0] * 33) for i in range(50)]
    rows += [(700 + i, [1e6 * (1 + i % 3)] * 33) for i in range(30)]
    check(spark, rows, 20)
    check(spark, rows[300:400] + rows[500:560], 3)


def test_empty(spark):
    check(spark, [(1, [1.0])], 5)
    check(spark, [], 5)


def test_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 64)) * np.linspace(3, 0.1, 64)
    found = topk.search(np.arange(10), np.floor(64 * x[:10]).T.astype(np.int64), np.arange(3000), np.floor(64 * x).T.astype(np.int64), 20)
    y = np.floor(64 * x).astype(np.int64)
    for q, (ids, scores) in enumerate(found):
        s = y @ y[q]
        s[q] = -(2**60)
        assert ids.tolist() == np.lexsort((np.arange(3000), -s))[:20].tolist()

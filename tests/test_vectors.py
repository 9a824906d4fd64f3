"""Pruned vector search against all pairs in numpy."""

import numpy as np
import pytest

from millrace.operators import vectors as V

VECTORS = "record_id string, chunk_id long, embedding array<float>"
REQUESTS = "request_id string, query_vector array<float>"


def clustered(seed, n, clusters=12, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    own = rng.integers(0, clusters, n)
    # one cluster holds a third of all vectors
    own[rng.random(n) < 0.33] = 0
    points = centres[own] + 0.15 * rng.normal(size=(n, dim))
    return [(f"r{c}-{i % 7}", i, p.astype(np.float32).tolist()) for i, (c, p) in enumerate(zip(own, points))]


def all_scores(vectors, requests):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    left = unit(np.array([q for _, q in requests], np.float64))
    right = unit(np.array([v for *_, v in vectors], np.float64))
    return np.round(left @ right.T, 6)


@pytest.mark.parametrize("rows", [2048, 16], ids=["one block", "many blocks"])
def test_equal_to_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(V, "BLOCK_ROWS", rows)
    monkeypatch.setattr(V, "REQUEST_ROWS", rows // 4)
    vectors = clustered(1, 1500)
    requests = [(r, v) for r, _, v in clustered(2, 60)] + [(r, v) for r, _, v in vectors[:40]]
    requests = list({name: (name, v) for name, v in requests}.values())
    left, right = spark.createDataFrame(vectors, VECTORS), spark.createDataFrame(requests, REQUESTS)
    scores = all_scores(vectors, requests)
    for least in (0.9, 0.2):
        q, v = np.nonzero(scores >= least)
        expected = sorted((requests[i][0], vectors[j][0], vectors[j][1], scores[i, j]) for i, j in zip(q, v))
        assert sorted(map(tuple, V.hits(left, right, least).collect())) == expected
    every = len(vectors) * len(requests)
    assert 0 < V.scored_pairs(left, right, min_score=0.9) < every / 3
    best = {}
    for i, (name, _) in enumerate(requests):
        for j, (record, *_) in enumerate(vectors):
            if record != name:
                best.setdefault(name, {})[record] = max(scores[i, j], best.get(name, {}).get(record, -2))
    expected = sorted(
        (name, r, s, rank) for name, own in best.items()
        for rank, (r, s) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:3], 1)
    )
    assert sorted(map(tuple, V.nearest_records(left, right, 3).collect())) == expected
    assert 0 < V.scored_pairs(left, right, k=3) < every


def test_vectors_without_direction_meet_nothing(spark):
    bad = [[0.0, 0.0], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [], [1.0, 0.0, 0.0]]
    vectors = spark.createDataFrame([("a", 1, [1.0, 0.0]), (None, 2, [1.0, 1.0])] + [("b", 10 + i, v) for i, v in enumerate(bad)], VECTORS)
    rows = [("q", [2.0, 0.0]), ("p", [0.0, 3.0]), ("z", [0.0, 0.0]), ("n", None), ("m", [1.0, None])]
    requests = spark.createDataFrame(rows, REQUESTS)
    found = {tuple(r) for r in V.hits(vectors, requests, -1.0).collect()}
    assert found == {("q", "a", 1, 1.0), ("q", None, 2, 0.707107), ("p", "a", 1, 0.0), ("p", None, 2, 0.707107)}
    nearest = {tuple(r) for r in V.nearest_records(vectors, requests, 2).collect()}
    assert nearest == {("q", "a", 1.0, 1), ("p", "a", 0.0, 1)}


def test_dimension_without_pivot_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(V, "PIVOTS", 1)
    rows = [("a", 1, [1.0, 0.0]), ("a", 1, [1.0, 0.0]), ("b", 2, [0.0, 1.0, 0.0]), ("c", 3, [-1.0, 0.0])]
    requests = [("x", [1.0, 1.0]), ("y", [0.0, 2.0, 0.0])]
    left, right = spark.createDataFrame(rows, VECTORS), spark.createDataFrame(requests, REQUESTS)
    found = sorted(map(tuple, V.hits(left, right, -1.0).collect()))
    assert found == [("x", "a", 1, 0.707107), ("x", "a", 1, 0.707107), ("x", "c", 3, -0.707107), ("y", "b", 2, 1.0)]


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], VECTORS), spark.createDataFrame([("a", 1, [1.0])], VECTORS)
    no_request, request = spark.createDataFrame([], REQUESTS), spark.createDataFrame([("q", [1.0])], REQUESTS)
    assert V.hits(none, request, 0.0).count() == V.hits(one, no_request, 0.0).count() == 0
    assert V.nearest_records(none, request, 3).count() == V.nearest_records(one, no_request, 3).count() == 0

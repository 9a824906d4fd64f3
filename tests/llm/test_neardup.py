"""Near-duplicates against all pairs of a small table."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neardup
from millrace.llm.components import components


def shingle_set(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def plain(rows, k):
    sets = [shingle_set(t, k) for _, t in rows]
    low = lambda i: -(2**63) if i is None else i
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), low(d)), low(d))
    back = lambda i: None if i == -(2**63) else i
    return [(d, len(sets[i]), back(least[top(i)]), low(d) == least[top(i)]) for i, (d, _) in enumerate(rows)]


def check(spark, rows, k):
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, node string, own int")
    got = neardup.near_duplicates(docs.repartition(3), k).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(rows, k)))


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 5)))
    rows, base = [], [word() for _ in range(150)]
    for i in range(60):  # one group of near copies, some too far from the rest
        w = list(base)
        for _ in range(rng.choice([1, 3, 6, 9, 12, 20])):
            w[rng.randrange(len(w))] = word()
        rows.append((100 + i, " ".join(w)))
    for i in range(60):
        w = [word() for _ in range(rng.choice([1, 2, 3, 5, 30, 80]))]
        rows.append((300 + 2 * i, " ".join(w)))
        if i % 2:
            w[rng.randrange(len(w))] = word()
            rows.append((301 + 2 * i, " ".join(w).upper() if i % 3 else " ".join(w)))
    rows += [(600 + i, rows[0][1].upper() + "\n") for i in range(10)]
    rows += [(700, None), (701, ""), (702, " \n"), (None, "null id"), (703, "null id"), (704, "Ä b"), (705, "ä b"), rows[7], rows[7]]
    return rows + [(800, "x y " * 20_000), (801, "y x " * 20_000), (rows[3][0], "same id other text entirely")]


@pytest.mark.parametrize("k", [2, 5])
def test_components(spark, k):
    check(spark, made(k), k)


def test_empty(spark):
    check(spark, [], 2)
    check(spark, [(1, None), (2, "")], 2)


def test_keys_meet_all_close_signatures():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 256, neardup.PLACES)
        b = a.copy()
        b[rng.choice(neardup.PLACES, 19, replace=False)] += 1
        chunks = lambda s: s.reshape(neardup.CHUNKS, neardup.PER_CHUNK)
        assert ((chunks(a) != chunks(b)).sum(1) <= 1).any()


def test_a_pair_is_made_at_the_first_key_that_it_shares(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        a = [[rng.randrange(256) for _ in range(neardup.PER_CHUNK)] for _ in range(neardup.CHUNKS)]
        b = [list(c) for c in a]
        for c in b:
            for place in rng.sample(range(neardup.PER_CHUNK), rng.choice([0, 1, 1, 2, 3])):
                c[place] = (c[place] + rng.choice([1, 128, 255])) % 256
        code = lambda s: [sum(v << 8 * p for p, v in enumerate(c)) for c in s]
        shared = [
            neardup.PER_CHUNK * c + p
            for c in range(neardup.CHUNKS)
            for p in range(neardup.PER_CHUNK)
            if all(a[c][q] == b[c][q] for q in range(neardup.PER_CHUNK) if q != p)
        ]
        rows += [(i, number, code(a), code(b), number != shared[0]) for number in shared]
    table = spark.createDataFrame(rows, "id int, number int, a array<long>, b array<long>, later boolean")
    side = lambda c, name: table.select("id", "number", "later", *neardup.earlier(F.col("number"), F.col(c))).alias(name)
    met = side("a", "x").join(side("b", "y"), ["id", "number"])
    got = met.select(neardup.shared_before().alias("got"), F.col("x.later").alias("wanted")).collect()
    assert len(got) == len(rows) and all(r.got == r.wanted for r in got)
    assert {r.wanted for r in got} == {True, False}


def test_join_of_remaining_pairs_is_compiled_in_small_methods(spark, capsys):
    # As one method of 6,952 bytes, the join's loop took its compiler 360 MB of each executor.
    numbers = lambda names: ", ".join(f"{c} long" for c in names)
    members = spark.createDataFrame([], "key long, number int, node long, first long, root long")
    nodes = spark.createDataFrame([], "node long, n_shingles long, " + numbers(neardup.COLUMNS))
    outlines = spark.createDataFrame([], "node long, " + numbers(neardup.OUTLINE))
    checked = spark.createDataFrame([], "a long, b long, both long, linked boolean")
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        neardup.remaining_pairs(members, nodes, outlines, checked, 80).explain("codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 5000


def test_star_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(50)] + [(500, 500)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent if top(x) != x}


def test_drop_copies(spark):
    rows = made(1)
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    out = neardup.drop_copies(docs, neardup.near_duplicates(docs, 2))
    assert out.columns == docs.columns
    dropped = {d for d, _, _, kept in plain(rows, 2) if not kept}
    assert sorted(map(repr, [r.doc_id for r in out.collect()])) == sorted(repr(d) for d, _ in rows if d not in dropped)


def survivors(rows, k):
    """(id, text) of the rows that are left; equal texts under a null id once."""
    low = lambda i: -(2**63) if i is None else i
    sets = [shingle_set(t, k) for _, t in rows]
    left = {(d, t or "") for (d, t), s in zip(rows, sets) if not s}
    todo = {i for i, s in enumerate(sets) if s}
    while todo:
        group, queue = set(), [todo.pop()]
        while queue:
            i = queue.pop()
            group.add(i)
            near = {j for j in todo if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
            todo -= near
            queue += near
        best = min(group, key=lambda i: (low(rows[i][0]), neardup.text_key(rows[i][1] or "")))
        left.add((rows[best][0], rows[best][1]))
    stay = [(d, t or "") for d, t in rows if (d, t or "") in left]
    return [r for r in stay if r[0] is not None] + [r for r in set(stay) if r[0] is None]


def check_dropped(spark, rows, k):
    docs = spark.createDataFrame([(*r, "en", b"x") for r in rows], "doc_id long, text string, lang string, extra binary")
    out = neardup.drop_copies(docs.repartition(3), neardup.near_duplicates(docs, k))
    assert out.columns == docs.columns
    assert sorted((repr(r.doc_id), r.text or "") for r in out.collect()) == sorted((repr(d), t) for d, t in survivors(rows, k))


def test_drop_copies_under_repeated_ids(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, near), (2, near + " end"), (2, "clean text under a repeated id"), (3, "one and only"), (3, "one and only")]
    rows += [(None, "null id")] * 3 + [(None, "other null id"), (5, None), (5, ""), (6, near + " more"), (7, "same id " * 9 + near), (7, near * 3)]
    rows += [(8, "p q r s t u v w x y z 1"), (8, "p q r s t u v w x y z 2")]
    check_dropped(spark, rows, 2)
    check_dropped(spark, [], 2)

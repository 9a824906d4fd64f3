"""Anchored repeats against a plain index of all windows."""

import hashlib
import random

from millrace.llm import substrings


def plain(rows):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    low = lambda i: -(2**63) if i is None else i
    least = {}
    for i, w in docs:
        for s in range(len(w) - 12):
            k = tuple(w[s : s + 13])
            least[k] = min(least.get(k, low(i)), low(i))
    out = []
    for i, w in docs:
        gone = {s + j for s in range(len(w) - 12) if least[tuple(w[s : s + 13])] < low(i) for j in range(13)}
        left = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return out


def check(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "g", 1) for r in rows], "doc_id long, text string, grp string, n_words int")
    got = [tuple(r) for r in substrings.remove_repeats(docs.repartition(parts)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows)))


def test_random(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(rng.randint(8, 60))] for _ in range(30)]
    rows = []
    for i in range(250):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [word() for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            a = rng.randint(0, max(0, len(p) - 13))
            w += p[a : rng.randint(a, len(p))] if rng.random() < 0.7 else p
        rows.append((i * 7 % 251, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [rows[3], rows[3]]
    check(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 1000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a " * 12), (5, "a " * 13), (6, "a " * 14), (None, "a " * 13), (None, "b " * 20), (7, "b " * 20)]
    rows += [(8, long), (9, "x " + long), (10, "one two"), (-5, "c " * 40), (0, "c " * 39), (11, "é b " * 20), (12, "é b " * 20)]
    check(spark, rows)


def test_empty(spark):
    check(spark, [], 1)
    check(spark, [(1, "a b c")], 1)
    docs = spark.createDataFrame([(1, "a " * 20), (2, "z " + "a " * 20)], "doc_id long, text string")
    got = {r.doc_id: r.clean_text for r in substrings.remove_repeats(docs, keep_text=True).collect()}
    assert got == {1: " ".join("a" * 20), 2: "z"}

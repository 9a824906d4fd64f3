"""Spelling variants against plain Python: every pair of words by a full edit matrix."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import spelling


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def plain_python(rows):
    total = Counter()
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and edits(w, v) == 1] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def texts(seed, count):
    """Texts of a few stems and their misspellings; one stem is a third of all words."""
    rng = random.Random(seed)
    letters = "aabcdeorsté×ÿ"
    stems = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(12)]
    words = []
    for stem in stems:
        for _ in range(6):
            i, how = rng.randrange(len(stem)), rng.randrange(4)
            c = rng.choice(letters)
            words.append([stem, stem[:i] + c + stem[i + 1 :], stem[:i] + stem[i + 1 :], stem[:i] + c + stem[i:]][how])
    weights = [3 ** (k % 6) for k in range(len(words))]
    rows = []
    for d in range(count):
        chosen = rng.choices(words, weights, k=40) + [stems[0]] * 20
        rows.append((d, rng.choice([" ", ", ", "-1", "\n", "中"]).join(w.upper() if rng.random() < 0.1 else w for w in chosen)))
    return rows


@pytest.mark.parametrize("limit", [20_000, 1], ids=["ranges", "finer ranges"])
def test_documents_equal_plain_python(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "RANGE_WORDS", limit)
    rows = texts(3, 300) + [(1, None), (2, ""), (None, "abcdefg " * 30), (4, "abcdefg abcdefh " * 9), (4, "abcdefg abcdefh " * 9), (9, "q" * 30_000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_python(rows)


def test_chain_and_ties(spark):
    times = {"aaaaab": 5, "aaaabb": 25, "aaabbb": 200, "aabbbb": 1000, "zzzzzz": 7, "zzzzzy": 7, "zzzzzx": 35, "zzzzzw": 35}
    rows = [(2, " ".join(w for w, n in times.items() for _ in range(n)))]
    assert plain_python(rows)[0][:3] == ("aaaaab", "aaaabb", "aabbbb")
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_python(rows)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    short = spark.createDataFrame([(1, "few short words")], "doc_id long, text string")
    assert spelling.variants(short).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=40))
def test_scan_finds_all_pairs(words):
    words = sorted(words)
    expected = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if edits(words[i], words[j]) == 1}
    found = list(spelling.neighbours(words))
    assert set(found) == expected and len(found) == len(expected)

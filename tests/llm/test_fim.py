"""Fill-in-middle against plain Python, and the rank index against its own list."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_python(doc_id, text, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if text == "" or any(m in text for m in fim.MARKERS) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [
    None, "", " ", "\n\t ", "word", " word", "word ", "  two  words  ", "a\x0bb\x0cc\rd", "naïve café 日本語 🎉 é",
    "has <P> inside", "has <S> inside", "<M>", "almost <P <S <M <", "x " * 3000, "y" * 50_000, "z" * 9000 + " " + "w " * 500 + " " * 4000,
    "nul \x00 byte", "no break space\u0085", "<" * 40,
]


def test_documents_equal_plain_python(spark):
    rows = [(i * 7 + j, t, "n", 1) for j in range(12) for i, t in enumerate(TEXTS)]
    rows += [(None, "null id here", "n", 1), (5, "same", "n", 1), (5, "same", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n_units int")
    got = fim.transform(docs).withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    expected = [(i, *plain_python(i, t), t or "") for i, t, *_ in rows]
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_kept_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, output string")
    assert fim.transform(docs).count() == 0
    kept = fim.transform(spark.createDataFrame([(1, "a b", "de")], "doc_id long, text string, lang string"), keep=("doc_id", "lang"))
    assert kept.columns == ["doc_id", "lang", "n_units", "form", "prefix_chars", "middle_chars", "output"]


def test_seed_and_rates(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    shares = dict(fim.transform(docs, fim_percent=100, spm_percent=0).groupBy("form").count().collect())
    assert shares == {"psm": 400}
    assert fim.transform(docs, fim_percent=0).where("form <> 'plain'").count() == 0
    assert fim.transform(docs, seed=1).exceptAll(fim.transform(docs, seed=2)).count() > 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4000), max_size=60), min_size=1, max_size=6), st.sampled_from([0, 3, 127]))
def test_index_is_exact_and_bounded(steps, most):
    lists = [np.cumsum([0, *s]) for s in steps]
    offsets = np.concatenate(lists)
    firsts = np.cumsum([0, *map(len, lists)])[:-1]
    index = fim.RankIndex(offsets, firsts, most)
    ranks = np.arange(len(offsets))
    assert (index.offset(ranks) == offsets).all()
    assert np.abs(index.predict(ranks) - offsets).max() <= most
    assert set(firsts) <= set(index.starts)


def test_index_is_smaller_than_the_list():
    rng = np.random.default_rng(5)
    offsets = np.cumsum(rng.integers(2, 11, 200_000))
    index = fim.RankIndex(offsets, np.array([0]))
    assert len(index.starts) < 1500 and index.residuals.nbytes == len(offsets)


def test_error_must_fit_a_byte():
    with pytest.raises(ValueError):
        fim.RankIndex(np.array([0, 1]), np.array([0]), 128)

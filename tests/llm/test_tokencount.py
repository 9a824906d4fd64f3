"""Token counts against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import tokencount
from millrace.llm.bpe import PRETOKEN, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "a", "it's we'll 'd x'S", "same words same words same words", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>",
    "日本語のテキスト 🎉🎉 é̀ ß", "\x1c a\x1d b \u0085 c", "ab" * 3000 + " " * 500 + "z", "y" * 60_000, "\t\tx\r\n y", "word " * 20_000, "nul \x00 byte",
]


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def expected_rows(theirs, rows):
    size = lambda t: len(theirs.encode(t or "", add_special_tokens=False).ids)
    return sorted((repr(i), len((t or "").encode()), size(t)) for i, t in rows)


def test_documents_equal_library(spark, theirs):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "twice"), (3, "twice"), (3, "twice again")]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, piece string, n_tokens int")
    got = tokencount.count_tokens(docs, PATH).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected_rows(theirs, rows)


def test_many_small_blocks(spark, theirs, monkeypatch):
    monkeypatch.setattr(tokencount, "BLOCK_BYTES", 200)
    rows = [(i, " ".join(["the"] * (i % 7) + [f"word{i % 11}"] * (i % 5))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = tokencount.count_tokens(docs, PATH).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected_rows(theirs, rows)


def test_empty_table_and_kept_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokencount.count_tokens(docs, PATH).count() == 0
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "de")], "doc_id long, text string, `a b` string")
    got = tokencount.count_tokens(docs, PATH, keep=("doc_id", "a b")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, None, 3, 2), (2, "de", 0, 0)]


def test_texts_do_not_travel(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("one two two three").alias("text")).repartition(5)
    plan = tokencount.count_tokens(docs, PATH)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [piece" in plan and "text" not in plan


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    bpe, library = _pair()
    assert sum(bpe.length(p) for p in PRETOKEN.findall(text)) == len(library.encode(text, add_special_tokens=False).ids)


_made = []


def _pair():
    if not _made:
        with open(PATH, encoding="utf-8") as file:
            _made.extend([encoder(file.read()), Tokenizer.from_file(PATH)])
    return _made

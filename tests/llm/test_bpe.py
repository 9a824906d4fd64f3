"""Forced-boundary BPE against the tokenizers library, and exact round trips."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as file:
        return bpe.ByteBpe(file.read())


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


CASES = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n \n", "it's we'll 'd x'S", "q x zq'q 12a34",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext", "\u0085 a  b　c", "\x1c a\x1d b",
    "a" * 5000, "ab" * 3000 + " " * 500 + "z", "日本語のテキスト 🎉🎉 é̀ ß", "\t\tx\r\n y", "0123456789" * 50, "​ x﻿ y",
]


@pytest.mark.parametrize("text", CASES, ids=range(len(CASES)))
def test_same_ids(ours, theirs, text):
    expected = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == expected
    assert ours.decode(expected) == theirs.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    a, b = _pair()
    expected = b.encode(text, add_special_tokens=False).ids
    assert a.encode(text) == expected
    assert a.decode(expected) == text


_made = []


def _pair():
    if not _made:
        with open(PATH, encoding="utf-8") as file:
            _made.extend([bpe.ByteBpe(file.read()), Tokenizer.from_file(PATH)])
    return _made


def test_heap_equals_scan(ours):
    rng = random.Random(3)
    for _ in range(200):
        piece = bytes(rng.choice(b"aeinorst th") for _ in range(rng.randint(1, 60)))
        assert ours._heap(piece) == ours._scan(piece)
        assert ours._merged(piece) == ours._scan(piece)


def test_cuts_are_certain(ours):
    for i, token in enumerate(ours.tokens):
        if i not in ours.special.values():
            assert all(ours.inside[a, b] for a, b in zip(token, token[1:]))


def test_table(spark, theirs):
    rows = [(1, "a b", 7), (1, "a b", 7), (2, None, 8), (3, "", 9), (None, "x" * 200_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids long")
    got = bpe.encode_documents(docs, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id, len(r.token_ids), len(r.decoded)) for r in got if r.doc_id) == [
        (False, 1, 2, 3), (False, 1, 2, 3), (False, 2, 0, 0), (False, 3, 0, 0)
    ]
    long = next(r for r in got if r.doc_id is None)
    assert long.decoded == "x" * 200_000
    assert list(long.token_ids) == theirs.encode("x" * 200_000, add_special_tokens=False).ids
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0

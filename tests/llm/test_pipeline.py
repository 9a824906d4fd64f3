"""The pipeline's stages on a small table: their contracts, and the last three against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from millrace.llm import secrets
from millrace.llm.queries import TOKENIZER
from tests.llm.test_neardup import plain as plain_copies

KIND = "doc_id long, text string, lang string, source string, n_chars long, node string, __size long"
SF = "/root/testdata/sf0.001"


def made():
    rng = random.Random(3)
    names = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(names, k=rng.randint(1, 120))) for _ in range(60)]
    texts += [texts[3], texts[3], texts[4] + " end", texts[5].upper()]
    texts += ["the password = Abcd1234efgh is here", "key AKIA" + "Q7" * 8 + " and " + "0f" * 20, "", None, " \n ", "x " * 3000]
    rows = [(i, t, "en", "ab"[i % 2] if i % 7 else None, len(t or ""), "n", i) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (None, "no id at all " * 8, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), KIND).repartition(5).cache()


def test_quality_keeps_what_scores_enough(spark, docs):
    kept = pipeline.accept_quality(spark, docs, SF)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).isEmpty()
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    left = pipeline.accept_quality(spark, whole, SF).join(good, "doc_id").count()
    assert left >= 0.97 * whole.join(good, "doc_id").count()


def test_near_copies(spark, docs):
    rows = made()
    got = pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    judged = plain_copies([r[:2] for r in rows], 5)
    wanted = [r for r, j in zip(rows, judged) if j[3]]
    order = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert order(got.collect()) == order(wanted)


def test_secrets_are_gone(spark, docs):
    got = {r["doc_id"]: r for r in pipeline.redact_secrets(spark, docs, SF).collect()}
    rows = made()
    assert len(got) == len({r[0] for r in rows})
    for r in rows:
        new = got[r[0]]
        assert not secrets.base_spans(new["text"] or "")
        if not secrets.base_spans(r[1] or "") and "<secret>" not in (new["text"] or ""):
            assert (new["text"], new["n_chars"]) == (r[1], r[4])
        elif new["text"] is not None:
            assert new["n_chars"] == len(new["text"])


def test_mix_has_the_words_of_its_targets(spark, docs):
    got = pipeline.mix_to_targets(spark, docs, SF)
    assert got.columns == docs.columns
    count = lambda t: len((t or "").encode().split())
    sizes, words = {}, {}
    for r in made():
        sizes[r[3]] = sizes.get(r[3], 0) + count(r[1])
    for r in got.collect():
        words[r["source"]] = words.get(r["source"], 0) + count(r["text"])
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"])
    whole = sum(sizes.values())
    # Weights 1, 2, 3 for a, b and null.
    for source, weight in (("a", 1), ("b", 2), (None, 3)):
        assert words[source] <= 3 * sizes[source]
        if all(whole * w / 6 <= 3 * sizes[s] for s, w in (("a", 1), ("b", 2), (None, 3))):
            assert abs(words[source] - whole * weight / 6) <= 1


def test_tokens_equal_the_library(spark, docs):
    theirs = Tokenizer.from_file(str(TOKENIZER))
    theirs.no_truncation()
    theirs.no_padding()
    got = pipeline.encode_tokens(spark, docs, SF).collect()
    wanted = sorted(repr((r[0], theirs.encode(r[1] or "", add_special_tokens=False).ids)) for r in made())
    assert sorted(repr((r["doc_id"], list(r["token_ids"]))) for r in got) == wanted
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got)


def test_empty_table_and_whole_run(spark):
    empty = spark.createDataFrame([], KIND)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).isEmpty()
    done = pipeline.run(spark, SF)
    assert done.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
    assert done.where(F.size("token_ids") != F.col("n_tokens")).isEmpty() and not done.isEmpty()
    assert [name for name, _ in pipeline.STAGES if not re.fullmatch(r"[a-z -]+", name)] == []

"""A training corpus from documents: quality, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents.  All but the last return the columns of
``documents``; columns beyond the usual five travel along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, mixing, neardup, quality, secrets
from millrace.llm.queries import TOKENIZER
from millrace.session import configure, run_dir

SECRET_MARK = "<secret>"
USUAL = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def any_columns(stage: Stage) -> Stage:
    """Hide the names of extra columns from a stage, so that none meets a name of its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in USUAL else f"extra_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    return run


@any_columns
def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    configure(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels), keep=tuple(docs.columns))
    return scored.where(F.col("quality_score") >= quality.ACCEPT).drop("quality_score")


@any_columns
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Rows that repeat an id and its text are one document and stay together; a null id names
    none, so of equal texts under it one stays.
    """
    configure(spark)
    return neardup.drop_copies(docs, neardup.near_duplicates(docs))


@any_columns
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    configure(spark)
    rest = tuple(c for c in docs.columns if c != "text")
    found = secrets.find_secrets(docs, secrets.train(docs), keep=rest, redact=SECRET_MARK)
    hit = F.size("secret_spans") > 0
    changed = {"text": F.col("clean_text"), "n_chars": F.when(hit, F.length("clean_text").cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


@any_columns
def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of a source as often as its target asks, the last ones in part.

    They weigh by the quality classifier.  It is trained on the documents that the pipeline
    began with, as in the first stage: only accepted ones are left here.
    """
    configure(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return mixing.repeat_taken(docs, mixing.mix_sources(docs, model))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids of every document; extra columns end here."""
    configure(spark)
    docs = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.encode_documents(docs, TOKENIZER, keep=("doc_id", "lang", "source"), decode=False)
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality classifier", accept_quality),
    ("near-duplicates", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing to targets", mix_to_targets),
    ("token encoding", encode_tokens),
]

#: Trained models and hashed sampling keys have no SQL form; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = run_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Chunking jobs and the audits that nothing was lost, repeated or changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import chunks as C
from millrace.functions.ids import chunk_uuid
from millrace.functions.plan import once
from millrace.schemas import CATEGORIES


def with_blocks(df: DataFrame, text: str = "text") -> DataFrame:
    """Labelled blocks of each record; each step is its own column so it runs once."""
    spans = once(df, _spans=C.split_spans(F.col(text)))
    parts = once(spans, _parts=C.split_blocks(F.col("_spans"))).drop("_spans")
    return once(parts, blocks=C.label_blocks(F.col("_parts"))).drop("_parts")


def with_chunks(df: DataFrame, text: str = "text", limit: int | None = None) -> DataFrame:
    """Rule-made chunks: one per category, cut at block ends where longer than ``limit``."""
    blocked = with_blocks(df, text)
    if limit is None:
        return once(blocked, chunks=C.merge_blocks(F.col("blocks"))).drop("blocks")
    merged = once(blocked, joined=C.merge_blocks(F.col("blocks"), C.SEP)).drop("blocks")
    return once(merged, chunks=C.split_oversize(F.col("joined"), limit)).drop("joined")


def span_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    return df.select(key, F.posexplode(C.split_spans(F.col(text))).alias("pos", "span"))


def categorize_spans(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    return once(span_rows(df, key, text), category=C.categorize(F.col("span")))


def chunk_rows(df: DataFrame, key: str, chunks: str = "chunks") -> DataFrame:
    return df.select(key, F.posexplode(chunks).alias("chunk_pos", "chunk")).select(
        key, "chunk_pos", F.col("chunk.category").alias("category"), F.col("chunk.content").alias("content")
    )


def category_violations(rows: DataFrame) -> DataFrame:
    """Chunk rows outside the nine categories; the list is a constant, so no join."""
    return rows.filter(F.col("category").isNull() | ~F.col("category").isin(*CATEGORIES))


def _span_keys(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.select(key, F.explode(C.split_spans(F.col(text))).alias("span")).select(
        key, F.sha2("span", 256).alias("span_hash")
    )


def coverage_audit(source: DataFrame, rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Spans whose count in the chunks differs from their count in the source.

    Both sides go through one tagged union and one aggregation, so counts are
    combined before the shuffle and no join meets a hot span.
    """
    return _count_differences(
        _span_keys(source, key, text)
        .withColumn("in_source", F.lit(1))
        .unionByName(_span_keys(rows, key, "content").withColumn("in_source", F.lit(0))),
        key,
    )


def coverage_audit_in_row(df: DataFrame, key: str, text: str, chunks: str = "chunks") -> DataFrame:
    """The same audit where a row holds both its text and its chunks: one scan, one explode."""

    def tagged(spans: Column, in_source: int) -> Column:
        return F.transform(
            spans, lambda s: F.struct(F.sha2(s, 256).alias("span_hash"), F.lit(in_source).alias("in_source"))
        )

    pieces = F.flatten(F.transform(chunks, lambda c: C.split_spans(c["content"])))
    both = F.concat(tagged(C.split_spans(F.col(text)), 1), tagged(pieces, 0))
    return _count_differences(df.select(key, F.inline(both)), key)


def _count_differences(tagged: DataFrame, key: str) -> DataFrame:
    counts = tagged.groupBy(key, "span_hash").agg(
        F.sum("in_source").alias("n_source"), F.sum(1 - F.col("in_source")).alias("n_chunks")
    )
    return counts.filter("n_source <> n_chunks").withColumn(
        "finding", F.when(F.col("n_chunks") < F.col("n_source"), "omitted").otherwise("added")
    )


def duplicate_spans(rows: DataFrame, key: str) -> DataFrame:
    counts = _span_keys(rows, key, "content").groupBy(key, "span_hash").agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")


def verbatim_audit(df: DataFrame, key: str, text: str, chunks: str = "chunks") -> DataFrame:
    """Chunk spans that are no exact piece of the record's own text (same row, no join)."""
    spans = df.select(key, text, F.posexplode(chunks).alias("chunk_pos", "chunk")).select(
        key, text, "chunk_pos", F.explode(C.split_spans(F.col("chunk.content"))).alias("span")
    )
    return spans.filter(~F.contains(F.col(text), F.col("span"))).select(key, "chunk_pos", "span")


def split_sentence_audit(rows: DataFrame, key: str) -> DataFrame:
    """Sentences found under more than one category; min/max stand in for a distinct count."""
    parts = rows.select(key, "category", F.explode(C.sentences(F.col("content"))).alias("sentence")).select(
        key, "category", F.sha2("sentence", 256).alias("sentence_hash")
    )
    found = parts.groupBy(key, "sentence_hash").agg(
        F.min("category").alias("first_category"), F.max("category").alias("last_category")
    )
    return found.filter("first_category <> last_category")


def chunk_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("chunk_id", chunk_uuid(F.col("category"), F.col("content")))

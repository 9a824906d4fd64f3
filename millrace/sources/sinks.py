"""Result sinks: message topics, the index table, the quarantine folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import RECORD_KEY

# Nulls stay in the JSON; timestamps are ISO-8601 in UTC.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'",
}


def serialize(value: Column) -> Column:
    return F.to_json(value, JSON_OPTIONS)


def result_messages(results: DataFrame, key: str, value: Column, headers: str | None = None) -> DataFrame:
    """Results as keyed messages; the incoming headers travel along where given."""
    carried = F.col(headers) if headers else F.lit(None).cast("array<struct<key:string,value:binary>>")
    return results.select(
        F.encode(F.col(key), "UTF-8").alias("key"),
        F.encode(serialize(value), "UTF-8").alias("value"),
        carried.alias("headers"),
    )


def extraction_value(record: Column, text: str = "extraction_text", record_key: str = RECORD_KEY) -> Column:
    return F.struct(record.alias(record_key), F.col(text).alias("extraction_text"))


def chunk_value(record: Column, chunks: str = "chunks", record_key: str = RECORD_KEY) -> Column:
    return F.struct(record.alias(record_key), F.col(chunks).alias("chunks"))


def write_to_topic(messages: DataFrame, bootstrap: str, topic: str, delivery_timeout_ms: int = 30_000) -> None:
    """Publish to a topic (the Kafka connector must be on the class path)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("kafka.delivery.timeout.ms", str(delivery_timeout_ms))
        .option("kafka.request.timeout.ms", str(max(1000, delivery_timeout_ms // 2)))
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )


def write_quarantine(failed: DataFrame, path: str) -> None:
    """Unusable answers as JSON lines, one folder per stage; failed jobs leave no part files."""
    failed.write.mode("append").partitionBy("stage").json(path)


def upsert(index: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Index after a batch: per key the newest row of the batch, else what was there.

    Batch rows are reduced to one per key before they meet the index, so a key that is
    repeated without end in the batch costs one row per input partition.  Rows of the
    index that the batch leaves alone pass an anti join and are not aggregated; where
    the batch's ids measure small enough to broadcast, the index is not shuffled at all.
    """
    columns = [c for c in batch.columns if c != key]
    newest = batch.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("row")).select(key, "row.*")
    kept = index.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest)

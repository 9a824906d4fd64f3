"""Message sources, batch and streaming, all with ``schemas.MESSAGE_SCHEMA``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import MESSAGE_SCHEMA

OFFSET_RESETS = ("earliest", "latest", "none")


def kafka_options(
    bootstrap: str,
    topic: str,
    group: str,
    auto_offset_reset: str = "earliest",
    consumers: int | None = None,
    max_poll_interval_ms: int = 300_000,
) -> dict[str, str]:
    """Spark's options for one subscribed topic.

    ``none`` means resume from the checkpoint and fail on lost data.  ``consumers``
    is the least number of input partitions, Spark's form of a consumer count.
    """
    if auto_offset_reset not in OFFSET_RESETS:
        raise ValueError(f"auto_offset_reset must be one of {OFFSET_RESETS}")
    if max_poll_interval_ms < 1000:
        raise ValueError("max_poll_interval_ms must be at least 1000")
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "kafka.group.id": group,
        "kafka.max.poll.interval.ms": str(max_poll_interval_ms),
        "includeHeaders": "true",
        "startingOffsets": "latest" if auto_offset_reset == "latest" else "earliest",
        "failOnDataLoss": "true" if auto_offset_reset == "none" else "false",
    }
    if consumers:
        options["minPartitions"] = str(consumers)
    return options


def kafka_stream(spark: SparkSession, **settings) -> DataFrame:
    """Streaming messages of one topic (the Kafka connector must be on the class path)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(**settings))
    return reader.load().select(*MESSAGE_SCHEMA.fieldNames())


def _file_schema() -> T.StructType:
    """Messages in JSON files carry text where the broker carries bytes."""
    text = T.StringType()
    header = T.StructType([T.StructField("key", text), T.StructField("value", text)])
    swaps = {"key": text, "value": text, "headers": T.ArrayType(header)}
    return T.StructType([T.StructField(f.name, swaps.get(f.name, f.dataType)) for f in MESSAGE_SCHEMA])


def _as_messages(files: DataFrame) -> DataFrame:
    headers = F.transform(
        "headers", lambda h: F.struct(h["key"].alias("key"), F.encode(h["value"], "UTF-8").alias("value"))
    )
    return (
        files.withColumn("key", F.encode("key", "UTF-8"))
        .withColumn("value", F.encode("value", "UTF-8"))
        .withColumn("headers", headers)
        .select(*MESSAGE_SCHEMA.fieldNames())
    )


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    return _as_messages(spark.read.schema(_file_schema()).json(path))


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(_file_schema())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return _as_messages(reader.json(path))


def write_message_files(messages: DataFrame, path: str) -> None:
    """Messages as JSON lines, the counterpart of the file sources."""
    headers = F.transform(
        "headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))
    )
    (
        messages.withColumn("key", F.col("key").cast("string"))
        .withColumn("value", F.col("value").cast("string"))
        .withColumn("headers", headers)
        .select(*MESSAGE_SCHEMA.fieldNames())
        .write.mode("errorifexists")
        .json(path)
    )

"""Event-time windows over a change stream, and what came too late for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sliding_counts(stream: DataFrame, time: str, delay: str, length: str, slide: str, *keys: str) -> DataFrame:
    """Rows of each sliding window and key, counted as they come; rows of closed windows do not count."""
    window = F.window(time, length, slide)
    return stream.withWatermark(time, delay).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, time: str, delay: str, gap: str, key: str) -> DataFrame:
    """Sessions of each key, given once, when the watermark has passed their end."""
    spans = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), key)
    return spans.agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("last"))


def write_log(counts: DataFrame, path: str, checkpoint: str, mode: str) -> StreamingQuery:
    """Every trigger's rows under ``path/batch=<n>``; a trigger that runs again overwrites its own."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).start()


def newest_counts(log: DataFrame, *keys: str) -> DataFrame:
    """Final counts of an update log: the newest batch of each window."""
    return log.groupBy("window", *keys).agg(F.max_by("n", "batch").alias("n"))


def with_late(counted: DataFrame, rows: DataFrame, time: str, length: str, slide: str, *keys: str) -> DataFrame:
    """Windows with the rows that were counted (n) and those that came when they were closed (n_late).

    ``rows`` is everything that arrived.  A window all of whose rows were late has n = 0.
    """
    every = rows.groupBy(F.window(time, length, slide), *keys).agg(F.count(F.lit(1)).alias("n_all"))
    joined = every.join(counted, ["window", *keys], "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return joined.select("window", *keys, n.alias("n"), (F.col("n_all") - n).alias("n_late"))

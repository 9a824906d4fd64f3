"""Structured Streaming jobs over the same transforms as the batch queries."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import decode

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def newest_versions(stream: DataFrame, key: str, version: str) -> DataFrame:
    """Versions newer than any version of their id seen before, in update mode.

    The state is one aggregate per id with no expiry: the highest version and when it
    first came.  Rows are combined before they reach the state, so a hot id costs one
    row per input partition and trigger.  An id whose highest version did not first
    come in this trigger brought nothing new and is left out.
    """
    arrival = F.unix_micros(F.current_timestamp())
    seen = stream.withColumn("seen", F.struct(F.unix_micros(version).alias("version_us"), (-arrival).alias("neg_arrival")))
    newest = seen.groupBy(key).agg(F.max("seen").alias("newest"))
    return newest.filter(F.col("newest.neg_arrival") == -arrival).select(key, F.col("newest.version_us"))


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Every trigger's rows as parquet under ``path/batch=<n>``.

    A trigger that runs again after a failure overwrites its own folder, so each row is
    there once.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def use_large_state(spark: SparkSession) -> None:
    """Keep state on local disk with changes in the checkpoint, unless a store is chosen."""
    if spark.conf.get(PROVIDER_KEY, "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER_KEY, STATE_PROVIDER)


def version_filter(stream: DataFrame, key: str, version: str, path: str, checkpoint: str) -> StreamingQuery:
    use_large_state(stream.sparkSession)
    return write_batches(newest_versions(stream, key, version), path, checkpoint)


def decoded_items(messages: DataFrame) -> DataFrame:
    """Checked items of a message stream: the batch functions, unchanged."""
    decoded = decode.decode_messages(messages)
    return decode.check_items(decode.fan_out(decoded, "topic", "partition", "offset"))


BASE_RUN = "00000-base"


def index_run(spark: SparkSession, path: str, checkpoint: str) -> str:
    """Folder name of a stream's run in an index log: its place in the order, and its checkpoint.

    A stream that starts again with its checkpoint finds its own run.  Another checkpoint
    gets the next number, so no stream writes where another one, or the compaction, wrote.
    """
    own = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    runs = sorted(n.removeprefix("run=") for n in names if n.startswith("run="))
    mine = [r for r in runs if r.endswith(f"-{own}")]
    return mine[0] if mine else f"{max([int(r.split('-')[0]) for r in runs], default=0) + 1:05}-{own}"


def write_index_batch(batch: DataFrame, batch_id: int, path: str, run: str, key: str = "id") -> None:
    """Add one trigger's rows to an index kept as a log of batches.

    The batch is reduced to one row per id and written to its own folder; nothing that
    is already in the index is read or rewritten, so the cost follows the batch.
    """
    columns = [c for c in batch.columns if c != key]
    newest = batch.groupBy(key).agg(F.max_by(F.struct(*columns), "version").alias("row")).select(key, "row.*")
    newest.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")


def read_index(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Current index: per id the row of the newest batch of the newest run that has it."""
    log = spark.read.option("basePath", path).parquet(path)
    columns = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct("run", "batch")).alias("row")).select(key, "row.*")


def compact_index(spark: SparkSession, path: str, target: str, key: str = "id") -> None:
    """Write the current index as the base of a new log, which no stream writes to."""
    current = read_index(spark, path, key).drop("run", "batch")
    current.write.mode("errorifexists").parquet(f"{target}/run={BASE_RUN}/batch=0")


def index_stream(requests: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    run = index_run(requests.sparkSession, path, checkpoint)
    return (
        requests.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: write_index_batch(batch, batch_id, path, run))
        .start()
    )

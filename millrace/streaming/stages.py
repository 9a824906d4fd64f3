"""Running stages between message logs, with a ledger that advances after publishing.

A stage reads a log, skips versions that are done, works, publishes, and only then writes
down what it published.  Each micro-batch goes through four steps, all safe to run again:

1. due      the newest version of each id in the batch that the ledger of the batches
            before does not have (the batch's own folder is not read),
2. staged   what the work made of it, as a table of this batch, overwritten on a rerun,
3. published  under the token (stage, batch): a log takes a token once,
4. ledger   the published versions, as a folder of this batch, overwritten on a rerun.

A stage that fails between 3 and 4 publishes nothing twice, and one that fails before 3
has advanced nothing.  A record whose work came to nothing (a blank text, no chunks) is
not in the ledger, so it is worked on again when it is announced again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.plan import once
from millrace.functions.text import clean_document, is_blank
from millrace.operators import chunk, decode, dedup, shape
from millrace.schemas import RECORD_KEY
from millrace.sources import message_log, sinks

LEDGER_DDL = "id string, version timestamp"
KEPT_BATCHES = 64  # ledger folders read one by one before they are folded into a base

Work = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Stage:
    """``read`` gives id, version and payload columns of messages; ``work`` adds key, value,
    headers and succeeded to rows that are due."""

    name: str
    read: Work
    work: Work


def folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def ledger_before(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """id and version: what the batches before ``batch_id`` published (all, if not given)."""
    before = lambda n: batch_id is None or n < batch_id
    bases = [n for n in folders(spark, path, "base=") if before(n)]
    parts = [f"{path}/base={n}" for n in bases[-1:]]
    parts += [f"{path}/batch={n}" for n in folders(spark, path, "batch=") if before(n) and n > max(bases, default=-1)]
    if not parts:
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).parquet(*parts).groupBy("id").agg(F.max("version").alias("version"))


def seed_ledger(ledger: DataFrame, folder: str) -> None:
    """Start a stage's ledger with versions done elsewhere."""
    ledger.select("id", "version").write.mode("errorifexists").parquet(f"{folder}/ledger/base=-1")


def fold_ledger(spark: SparkSession, path: str, batch_id: int) -> None:
    """Replace many small folders by one base; the folders stay, so a rerun reads the same."""
    done = folders(spark, path, "base=")
    if batch_id - 1 - max(done, default=-1) >= KEPT_BATCHES:
        ledger_before(spark, path, batch_id).write.mode("overwrite").parquet(f"{path}/base={batch_id - 1}")


def run_batch(batch: DataFrame, batch_id: int, stage: Stage, folder: str, sink: str) -> None:
    """One micro-batch of a stage, as described at the top."""
    spark = batch.sparkSession
    offered = stage.read(batch)
    payload = [c for c in offered.columns if c not in ("id", "version")]
    newest = offered.groupBy("id").agg(F.max_by(F.struct("version", *payload), "version").alias("row")).select("id", "row.*")
    due = dedup.skip_seen(newest, ledger_before(spark, f"{folder}/ledger", batch_id), "id", "version")
    staged = f"{folder}/staged/batch={batch_id}"
    stage.work(due).select("id", "version", "succeeded", "key", "value", "headers").write.mode("overwrite").parquet(staged)
    done = spark.read.parquet(staged).filter("succeeded")
    message_log.publish(done.select("key", "value", "headers"), sink, f"{stage.name}:{batch_id}")
    done.select("id", "version").write.mode("overwrite").parquet(f"{folder}/ledger/batch={batch_id}")
    fold_ledger(spark, f"{folder}/ledger", batch_id)


def run_stage(stage: Stage, messages: DataFrame, folder: str, sink: str) -> StreamingQuery:
    """Work through all messages that are there; state, staging and checkpoint lie under ``folder``."""
    return (
        messages.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: run_batch(batch, batch_id, stage, folder, sink))
        .start()
    )


def outcomes(spark: SparkSession, stage: str, folder: str) -> DataFrame:
    """id and state of everything a stage worked on; of several batches the newest counts."""
    rows = spark.read.option("basePath", f"{folder}/staged").parquet(f"{folder}/staged")
    state = F.when(F.col("succeeded"), f"{stage}-succeeded").otherwise(f"{stage}-failed")
    return rows.groupBy("id").agg(F.max_by(state, "batch").alias("state"))


# --- the three stages of the chain ---------------------------------------------


def _events(messages: DataFrame) -> DataFrame:
    """Accepted items of change events."""
    decoded = decode.decode_messages(messages)
    checked = decode.check_items(decode.fan_out(decoded, "headers"))
    records = decode.typed_records(checked, "headers")
    return records.select(F.col("record.id").alias("id"), F.col("record.modifiedOn").alias("version"), "record", "headers")


def _extract(due: DataFrame, record_key: str) -> DataFrame:
    cleaned = once(due, text=clean_document(F.col("record.content")))
    value = sinks.extraction_value(F.col("record"), "text", record_key)
    return _messages(cleaned, value, ~is_blank(F.col("text")))


def _extracted(messages: DataFrame, record_key: str) -> DataFrame:
    read = decode.decode_extractions(messages, "headers", record_key=record_key).filter(F.col("record.id").isNotNull())
    return read.select(F.col("record.id").alias("id"), F.col("record.modifiedOn").alias("version"), "record", "text", "headers")


def _chunk(due: DataFrame, record_key: str) -> DataFrame:
    cut = chunk.with_chunks(due, "text")
    return _messages(cut, sinks.chunk_value(F.col("record"), record_key=record_key), F.size("chunks") > 0)


def _chunked(messages: DataFrame, record_key: str) -> DataFrame:
    read = decode.decode_chunk_results(messages, "headers", record_key=record_key).filter("exact_keys")
    return read.select(F.col("record.id").alias("id"), F.col("record.modifiedOn").alias("version"), "record", "chunks", "headers")


def _embed(due: DataFrame) -> DataFrame:
    flat = due.select("id", "version", "headers", "chunks", F.col("record.title").alias("title"))
    kept = once(flat, kept=shape.request_chunks(F.col("chunks")))
    value = F.struct(F.col("id").alias("id"), F.col("title").alias("title"), F.col("kept").alias("content_chunks"))
    return _messages(kept, value, F.size("kept") > 0)


def _messages(rows: DataFrame, value, succeeded) -> DataFrame:
    return rows.select(
        "id",
        "version",
        F.coalesce(succeeded, F.lit(False)).alias("succeeded"),
        F.encode("id", "UTF-8").alias("key"),
        F.encode(sinks.serialize(value), "UTF-8").alias("value"),
        "headers",
    )


def chain_stages(record_key: str = RECORD_KEY) -> tuple[Stage, Stage, Stage]:
    """Extraction, chunking and embedding; published results hold their record under ``record_key``."""
    key = {"record_key": record_key}
    return (
        Stage("extraction", _events, partial(_extract, **key)),
        Stage("chunking", partial(_extracted, **key), partial(_chunk, **key)),
        Stage("embedding", partial(_chunked, **key), _embed),
    )


def run_chain(spark: SparkSession, events: str, folder: str, record_key: str = RECORD_KEY) -> dict[str, str]:
    """All three stages from an event log to a log of index requests; the paths of the logs made."""
    logs = {"extraction": f"{folder}/extractions", "chunking": f"{folder}/chunks", "embedding": f"{folder}/requests"}
    source = events
    for stage in chain_stages(record_key):
        stream = message_log.read_log_stream(spark, source, group=stage.name)
        run_stage(stage, stream, f"{folder}/{stage.name}", logs[stage.name]).awaitTermination()
        source = logs[stage.name]
    return logs

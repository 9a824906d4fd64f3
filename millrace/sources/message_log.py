"""A message log over files as a Spark data source: batch and streaming, read and write.

    spark.dataSource.register(MessageLog)
    messages.write.format("message_log").option("token", "run-7").mode("append").save(path)
    spark.readStream.format("message_log").load(path)

Tasks write Parquet files under ``data`` and report them; the driver commits them all at
once as the next numbered manifest under ``commits``.  Readers follow manifests, so files
of lost or repeated tasks are never seen.  A manifest carries the token of the write that
made it (streams: the writer's token and the batch), and a token is committed once: a batch
that is written again after a failure leaves the log as it is.

A stream's offset is the number of manifests it has read.  ``maxcommits`` admits so many of
them to a micro-batch.  A message with an offset keeps its topic, partition and offset (a mirrored
log); to one without, the log gives its own name, the writing task and the next offset.

One writer commits at a time.  The path is any that pyarrow's file systems reach.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from millrace.schemas import MESSAGE_SCHEMA

FORMAT = "message_log"
BATCH_ROWS = 4096

ARROW_SCHEMA = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", "UTC")),
    ]
)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote."""

    name: str
    partition: int
    rows: int


@dataclass
class LogFile(InputPartition):
    """One data file and the offset of its first message."""

    name: str
    partition: int
    first: int


class Log:
    """The files of one log."""

    def __init__(self, path: str):
        if path.startswith("file:"):
            path = "/" + path.removeprefix("file:").lstrip("/")
        self.fs, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.name = path.rstrip("/").rsplit("/", 1)[-1]

    def manifests(self) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def manifest(self, name: str) -> dict:
        with self.fs.open_input_file(f"{self.root}/commits/{name}") as file:
            return json.loads(file.read())

    def files(self, start: int, end: int) -> list[LogFile]:
        names = self.manifests()[start:end]
        return [LogFile(*f) for name in names for f in self.manifest(name)["files"]]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One data file, streamed; nothing is written for no rows."""
        name, rows, file = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if file is None:
                    self.fs.create_dir(f"{self.root}/data")
                    file = pq.ParquetWriter(f"{self.root}/data/{name}", ARROW_SCHEMA, filesystem=self.fs, compression="zstd")
                file.write_batch(_whole(batch))
                rows += batch.num_rows
        finally:
            if file is not None:
                file.close()
        return Written(name if file else "", TaskContext.get().partitionId(), rows)

    def commit(self, messages: Sequence[Written | None], token: str) -> None:
        mark = hashlib.md5(token.encode()).hexdigest()[:16]
        known = self.manifests()
        if any(name.endswith(f"-{mark}.json") for name in known):
            self.abort(messages)
            return
        following = dict(self.manifest(known[-1])["next"]) if known else {}
        files = []
        for m in messages:
            if m is not None and m.rows:
                first = following.get(str(m.partition), 0)
                files.append([m.name, m.partition, first])
                following[str(m.partition)] = first + m.rows
        self.fs.create_dir(f"{self.root}/commits")
        target = f"{self.root}/commits/{len(known):012}-{mark}.json"
        draft = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as file:
            file.write(json.dumps({"files": files, "next": following}).encode())
        self.fs.move(draft, target)

    def abort(self, messages: Sequence[Written | None]) -> None:
        for m in messages:
            if m is not None and m.name:
                self.fs.delete_file(f"{self.root}/data/{m.name}")

    def read(self, part: LogFile) -> Iterator[pa.RecordBatch]:
        offset = part.first
        with self.fs.open_input_file(f"{self.root}/data/{part.name}") as source:
            for batch in pq.ParquetFile(source).iter_batches(BATCH_ROWS):
                n = batch.num_rows
                columns = {name: batch.column(name) for name in ARROW_SCHEMA.names}
                # Messages without an offset have no place of their own: the log gives them one.
                placeless = pc.is_null(columns["offset"])
                own = {"topic": self.name, "partition": part.partition, "offset": pa.array(range(offset, offset + n), pa.int64())}
                for name, value in own.items():
                    value = value if isinstance(value, pa.Array) else pa.scalar(value, ARROW_SCHEMA.field(name).type)
                    columns[name] = pc.if_else(placeless, pc.coalesce(columns[name], value), columns[name])
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=ARROW_SCHEMA)
                offset += n


def _whole(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch with all columns of a message; the missing ones are null."""
    given = dict(zip(batch.schema.names, batch.columns))
    columns = [
        given[f.name].cast(f.type) if f.name in given else pa.nulls(batch.num_rows, f.type) for f in ARROW_SCHEMA
    ]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


class LogReader(DataSourceReader):
    def __init__(self, log: Log):
        self.log = log

    def partitions(self) -> Sequence[InputPartition]:
        return self.log.files(0, len(self.log.manifests())) or [LogFile("", 0, 0)]

    def read(self, partition: LogFile) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition) if partition.name else iter(())


class LogStreamReader(DataSourceStreamReader):
    """Offsets count manifests.

    Spark asks for the latest offset without saying where it stands, so the reader keeps
    its own place: what it last offered, or, in a new run, what the runs before committed.
    """

    def __init__(self, log: Log, group: str, limit: int | None):
        self.log, self.limit = log, limit
        self.place = f"{log.root}/groups/{hashlib.md5(group.encode()).hexdigest()}.json"
        self.at = self._committed()

    def _committed(self) -> int:
        if self.log.fs.get_file_info(self.place).type == fs.FileType.NotFound:
            return 0
        with self.log.fs.open_input_file(self.place) as file:
            return json.loads(file.read())["commits"]

    def initialOffset(self) -> dict:
        self.at = 0
        return {"commits": 0}

    def latestOffset(self) -> dict:
        there = len(self.log.manifests())
        self.at = there if self.limit is None else min(there, self.at + self.limit)
        return {"commits": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = max(self.at, end["commits"])
        return self.log.files(start["commits"], end["commits"]) or [LogFile("", 0, 0)]

    def read(self, partition: LogFile) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition) if partition.name else iter(())

    def commit(self, end: dict) -> None:
        self.at = max(self.at, end["commits"])
        self.log.fs.create_dir(self.place.rsplit("/", 1)[0])
        with self.log.fs.open_output_stream(self.place) as file:
            file.write(json.dumps(end).encode())


class LogWriter(DataSourceArrowWriter):
    def __init__(self, log: Log, token: str):
        self.log, self.token = log, token

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.log.write(iterator)

    def commit(self, messages) -> None:
        self.log.commit(messages, self.token)

    def abort(self, messages) -> None:
        self.log.abort(messages)


class LogStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, log: Log, token: str):
        self.log, self.token = log, token

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.log.write(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.log.commit(messages, f"{self.token}:{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self.log.abort(messages)


class MessageLog(DataSource):
    """Options: path; token (writes), group and maxcommits (streaming reads)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return MESSAGE_SCHEMA

    def _log(self) -> Log:
        return Log(self.options["path"])

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(self._log())

    def streamReader(self, schema: StructType) -> LogStreamReader:
        limit = int(self.options["maxcommits"]) if "maxcommits" in self.options else None
        if limit is not None and limit < 1:
            raise ValueError("maxcommits must be at least 1")
        return LogStreamReader(self._log(), self.options.get("group", "default"), limit)

    def writer(self, schema: StructType, overwrite: bool) -> LogWriter:
        if overwrite:
            raise ValueError("a message log is only appended to")
        return LogWriter(self._log(), self.options.get("token") or uuid.uuid4().hex)

    def streamWriter(self, schema: StructType, overwrite: bool) -> LogStreamWriter:
        if "token" not in self.options:
            raise ValueError("a stream needs a token, which names it across restarts")
        return LogStreamWriter(self._log(), self.options["token"])


def publish(messages, path: str, token: str | None = None) -> None:
    """Append messages in one commit; a token that the log knows changes nothing."""
    _register(messages.sparkSession)
    writer = messages.write.format(FORMAT).mode("append")
    (writer.option("token", token) if token else writer).save(path)


def read_log(spark: SparkSession, path: str):
    _register(spark)
    return spark.read.format(FORMAT).load(path)


def read_log_stream(spark: SparkSession, path: str, group: str = "default", max_commits: int | None = None):
    _register(spark)
    reader = spark.readStream.format(FORMAT).option("group", group)
    return (reader.option("maxcommits", max_commits) if max_commits else reader).load(path)


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)

"""What several corpus operators share: durable tables, word hashes, Arrow passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

# The word of the contracts, as a class of single characters.  bytes.split() splits UTF-8
# at exactly these six characters, so Python code gets the same words without a regex.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

# Rows and bytes of text that one Arrow batch may hold.  Very long texts come alone.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}

#: Bytes of text that one group of documents should hold when a task must see it whole.
GROUP_BYTES = 8 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """Limit the Arrow batches of this session, so that memory follows the longest text."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def arrow_pass(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Map batches to columns.  ``make`` runs once in each task and returns the batch function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """Python strings one by one; null counts as empty."""
    for value in column:
        yield value.as_py() or ""


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each window of ``width`` words, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total *= np.uint64(0x100000001B3)
        total += hashes[j : j + n]
    return mix(total)


def text_groups(df: DataFrame, column: str = "text") -> int:
    """How many groups keep GROUP_BYTES of text each; read from the data, not from a setting."""
    row = df.agg(F.sum(F.octet_length(column))).first()
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, -(-(row[0] or 0) // GROUP_BYTES), 1)


def word_count(text):
    """Words of a text as a column: separators are squeezed, so no array of words is built."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(squeezed == "", F.lit(0)).otherwise(
        F.length(squeezed) - F.length(F.translate(squeezed, " ", "")) + 1
    ).cast("long")


def words_in(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def string_array(values) -> pa.Array:
    return pa.array(values, pa.string())


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins in sorted columns."""
    first = np.ones(len(columns[0]), bool)
    if len(first) > 1:
        first[1:] = False
        for c in columns:
            first[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(first)




def running_before(df: DataFrame, group: str, order: list[str], value: str, name: str = "before") -> DataFrame:
    """Sum of ``value`` over the rows of the same group that come earlier; nulls form the last group.

    Rows are range-partitioned by group and order, so one large group lies in many
    partitions.  Each partition reports its first and last group and the sum of the last;
    as many rows as there are partitions reach the driver and give each partition's start.
    """
    keys = [F.col(group).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order]]
    ordered = durable(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    numbered = ordered.withColumn("__part", F.spark_partition_id())
    kind = df.schema[group].dataType.simpleString()

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, first, last, total, single, part = False, None, None, 0, True, 0
        for batch in batches:
            part = batch.column("__part")[0].as_py() if batch.num_rows else part
            groups, values = batch.column(group).to_pylist(), batch.column(value).to_pylist()
            for g, v in zip(groups, values):
                if not seen:
                    seen, first, last = True, g, g
                elif g != last:
                    last, total, single = g, 0, False
                total += v
        if seen:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "first": first, "last": last, "total": total, "single": single}],
                schema=pa.schema([("part", pa.int32()), ("first", found), ("last", found), ("total", pa.int64()), ("single", pa.bool_())]),
            )

    found = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]
    narrow = numbered.select("__part", group, value)
    rows = narrow.mapInArrow(report, f"part int, first {kind}, last {kind}, total long, single boolean").collect()
    starts: dict[int, int] = {}
    open_group, carried = None, None
    for r in sorted(rows, key=lambda r: r.part):
        same = carried is not None and r.first == open_group
        starts[r.part] = carried if same else 0
        carried = r.total + (carried if same and r.single else 0)
        open_group = r.last

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, fresh = None, 0, True
        for batch in batches:
            groups, values = batch.column(group).to_pylist(), batch.column(value).to_pylist()
            if batch.num_rows and fresh:
                current, total, fresh = groups[0], starts[batch.column("__part")[0].as_py()], False
            out = []
            for g, v in zip(groups, values):
                if g != current:
                    current, total = g, 0
                out.append(total)
                total += v
            kept = [c for c in batch.schema.names if c != "__part"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(out, pa.int64())], names=[*kept, name]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return numbered.mapInArrow(add, f"{fields}, `{name}` long")


BITS = 26  # of an id bitmap: 8 MB, whatever the number of ids
SLICE_BITS = 16


def id_bit(column):
    return F.xxhash64(column).bitwiseAND((1 << BITS) - 1)


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the hashed bits of column ``id`` set; full bitmaps let everything pass."""
    bits = ids.select(id_bit("id").alias("bit")).distinct()
    bits = bits.select(F.shiftright("bit", SLICE_BITS).cast("int").alias("part"), F.col("bit").bitwiseAND((1 << SLICE_BITS) - 1).cast("int").alias("bit"))

    def fill(table: pa.Table) -> pa.Table:
        own = np.zeros(1 << SLICE_BITS, np.uint8)
        own[table["bit"].to_numpy()] = 1
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "data": pa.array([np.packbits(own).tobytes()], pa.binary())})

    whole = np.zeros(1 << BITS >> 3, np.uint8)
    size = 1 << SLICE_BITS >> 3
    for row in bits.groupBy("part").applyInArrow(fill, "part int, data binary").collect():
        whole[row.part * size : (row.part + 1) * size] = np.frombuffer(row.data, np.uint8)
    return whole


def in_bitmap(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 > 0

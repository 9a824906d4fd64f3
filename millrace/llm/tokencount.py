"""Token counts without token ids: every distinct pre-token is counted once.

1. Documents are pre-tokenized in blocks of about ``BLOCK_BYTES`` of text.  A block keeps
   its distinct pre-tokens and, for each document, which of them it holds how often: sorted
   indices as compressed differences, a few bits for an entry.
2. The blocks' pre-tokens are sorted together, so that equal ones follow each other.  Each
   distinct one is encoded once, only the number of its tokens is kept, and all its rows
   get that number: a merge join without a second shuffle.
3. Numbers other than one return to their blocks and meet the frequencies there, where a
   document's count is a sum of products.

A pre-token has one row in a block, however often the block's documents hold it, so the
commonest one has as many rows as there are blocks.  Texts travel nowhere.

Null and empty texts have no tokens.  Rows are independent of each other: repeated rows and
rows without an id each get their own count.  Extra columns are ignored, an empty table
gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import PRETOKEN, encoder
from millrace.llm.common import bounded
from millrace.session import run_dir

BLOCK_BYTES = 32 << 20


def packed(numbers: np.ndarray, kind: type) -> bytes:
    return zlib.compress(numbers.astype(kind).tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


class Block:
    """Documents with their pre-token frequencies."""

    def __init__(self, special: dict[str, int], split):
        self.special, self.split = special, split
        self.place = defaultdict(count().__next__)
        self.at: list[int] = []
        self.times: list[int] = []
        self.entries: list[int] = []
        self.fixed: list[int] = []
        self.kept: list[pa.StructArray] = []
        self.size = 0

    def add(self, kept: pa.StructArray, texts: pa.Array) -> None:
        self.kept.append(kept)
        for value in texts:
            text = value.as_py() or ""
            fixed = 0
            if self.split and any(s in text for s in self.special):
                found: Counter = Counter()
                for part in self.split.split(text):
                    if part in self.special:
                        fixed += 1
                    else:
                        found.update(PRETOKEN.findall(part))
            else:
                found = Counter(PRETOKEN.findall(text))
            self.at.extend(map(self.place.__getitem__, found))
            self.times.extend(found.values())
            self.entries.append(len(found))
            self.fixed.append(fixed)
            self.size += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        """Frequent pre-tokens get small indices, so that sorted indices differ little."""
        at, times = np.array(self.at, np.int64), np.array(self.times, np.int64)
        order = np.argsort(-np.bincount(at, minlength=len(self.place)), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        owner = np.repeat(np.arange(len(self.entries)), self.entries)
        at = rank[at]
        by = np.lexsort((at, owner))
        at, times = at[by], times[by]
        steps = np.diff(at, prepend=0)
        starts = (np.cumsum(self.entries) - self.entries)[np.array(self.entries) > 0]
        steps[starts] = at[starts]
        pieces = list(self.place)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([number], pa.int64()),
                "kept": one(pa.concat_arrays(self.kept)),
                "entries": one(pa.array(self.entries, pa.int32())),
                "fixed": one(pa.array(self.fixed, pa.int64())),
                "steps": pa.array([packed(steps, np.uint32)], pa.binary()),
                "times": pa.array([packed(times, np.uint32)], pa.binary()),
                "n_pieces": pa.array([len(order)], pa.int32()),
                "pieces": one(pa.array([pieces[i] for i in order], pa.string())),
            }
        )


def count_tokens(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, n_bytes and n_tokens of every row.

    The vocabulary file is read by the driver and sent to the tasks; its size is fixed.
    """
    spark = bounded(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    hidden = [f"c{i}" for i in range(len(keep))]
    source = docs.select(
        *[docs[c].alias(h) for c, h in zip(keep, hidden)],
        F.coalesce(F.octet_length(docs["text"]), F.lit(0)).cast("long").alias("n_bytes"),
        docs["text"].alias("text"),
    )
    fields = [(f.name, f.dataType.simpleString()) for f in source.drop("text").schema]
    kept = f"struct<{','.join(f'{n}:{t}' for n, t in fields)}>"

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        fresh = lambda: Block(bpe.special, bpe.split_special)
        block, number = fresh(), TaskContext.get().partitionId() << 32
        for batch in batches:
            own = pa.StructArray.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            block.add(own, batch.columns[-1])
            if block.size >= BLOCK_BYTES:
                yield block.row(number)
                block, number = fresh(), number + 1
        if block.entries:
            yield block.row(number)

    path = run_dir(spark, "token-counts")
    schema = f"block long, kept array<{kept}>, entries array<int>, fixed array<long>, steps binary, times binary, n_pieces int, pieces array<string>"
    source.mapInArrow(block_rows, schema).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path).select("block", F.posexplode("pieces").alias("at", "piece"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        piece, n = None, 0  # the last one of the batch before
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("piece")
            fresh = np.ones(len(own), bool)
            fresh[1:] = pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
            distinct = own.filter(pa.array(fresh)).to_pylist()
            sizes = [n if p == piece else bpe.length(p) for p in distinct[:1]] + [bpe.length(p) for p in distinct[1:]]
            piece, n = distinct[-1], sizes[-1]
            numbers = pa.array(np.array(sizes, np.int32)[np.cumsum(fresh) - 1])
            several = pc.not_equal(numbers, 1)
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), numbers], names=["block", "at", "n"]).filter(several)

    ordered = pieces.repartition("piece").sortWithinPartitions("piece")
    numbers = ordered.mapInArrow(numbered, "block long, at int, n int")

    def total(block: pa.Table, found: pa.Table) -> pa.Table:
        rows, sums = [], []
        for b in block.to_batches():
            for i in range(b.num_rows):
                value = np.ones(b.column("n_pieces")[i].as_py(), np.int64)
                value[found["at"].to_numpy()] = found["n"].to_numpy()
                entries = np.array(b.column("entries")[i].values, np.int64)
                steps, times = unpacked(b.column("steps")[i].as_py(), np.uint32), unpacked(b.column("times")[i].as_py(), np.uint32)
                ends = np.cumsum(entries)
                at = np.cumsum(steps.astype(np.int64))
                before = np.concatenate([[0], at])[ends - entries]
                products = np.concatenate([[0], np.cumsum(value[at - np.repeat(before, entries)] * times)])
                sums.append(products[ends] - products[ends - entries] + np.array(b.column("fixed")[i].values, np.int64))
                rows.append(b.column("kept")[i].values)
        columns = dict(zip([n for n, _ in fields], pa.concat_arrays(rows).flatten()))
        return pa.table(columns | {"n_tokens": pa.array(np.concatenate(sums), pa.int64())})

    out = ", ".join(f"{n} {t}" for n, t in fields)
    frequencies = spark.read.parquet(path).drop("pieces")
    summed = frequencies.groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(total, f"{out}, n_tokens long")
    return summed.toDF(*keep, "n_bytes", "n_tokens")

"""Exact vector search that skips what an angle rules out.

``PIVOTS`` vectors of the table, a fixed number, stand for cells.  Every vector lies in the
cell of its nearest pivot, in a band of angles around it.  Angles are a metric: a vector at
angle a from a pivot is at least |a - b| away from a request at angle b.  So a request that
wants scores of at least s, that is angles of at most acos(s), only meets the bands of each
cell that reach into [b - acos(s), b + acos(s)]; the others cannot hold a hit.

For the nearest k records, the pivots give the threshold: they are vectors of the table, so
the k-th best score among the pivots of other records is at most the k-th best of all.

A (cell, band) is cut into blocks of bounded size, and so are the requests that meet it.
Blocks and requests meet by an equi-join on (cell, band, block), and each meeting is one
matrix product.  Vectors of a dimension that has no pivot lie in a cell that all meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 32
BANDS = 60  # of three degrees each
BLOCK_ROWS = 2048
REQUEST_ROWS = 256
SCORE_DIGITS = 6
SLACK = 2e-6  # rounding of scores and angles, on the safe side

Pivots = dict[int, tuple[np.ndarray, list]]


def usable(column: str) -> Column:
    """Whether a vector has a direction: nothing null or not finite in it, and not all zero."""
    given = F.col(column)
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(given, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def choose_pivots(vectors: DataFrame) -> Pivots:
    """By dimension: unit vectors and their records.  PIVOTS rows come to the driver, whatever the table's size."""
    spread = F.xxhash64("chunk_id", "record_id")
    rows = vectors.select("record_id", "embedding").orderBy(spread, "record_id", "embedding").head(PIVOTS)
    sizes = sorted({len(r.embedding) for r in rows})
    own = {s: [r for r in rows if len(r.embedding) == s] for s in sizes}
    return {s: (unit(np.array([r.embedding for r in rs], np.float64)), [r.record_id for r in rs]) for s, rs in own.items()}


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of each dimension in a column of lists."""
    sizes = np.asarray(pc.list_value_length(column))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield at, unit(flat.reshape(len(at), size))


def _band(angle: np.ndarray) -> np.ndarray:
    return np.clip((angle / np.pi * BANDS).astype(np.int64), 0, BANDS - 1)


def placed(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """Vectors with dim, cell and band."""
    rows = vectors.select("record_id", "chunk_id", F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, cell, band = (np.full(batch.num_rows, -1, np.int64) for _ in range(3))
            for at, own in _by_size(batch.column("embedding")):
                dim[at] = own.shape[1]
                if own.shape[1] in pivots:
                    cosines = own @ pivots[own.shape[1]][0].T
                    cell[at] = cosines.argmax(axis=1)
                    band[at] = _band(np.arccos(np.clip(cosines.max(axis=1), -1, 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int32()) for c in (dim, cell, band))], names=[*batch.schema.names, "dim", "cell", "band"]
            )

    kind = rows.schema["record_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"record_id {kind}, chunk_id long, embedding array<double>, dim int, cell int, band int")


def aimed(requests: DataFrame, pivots: Pivots, min_score: float | None, k: int | None) -> DataFrame:
    """One row for each (cell, band) that a request can still use."""
    rows = requests.select("request_id", F.col("query_vector").cast("array<double>").alias("query_vector"))

    def reach(own: np.ndarray, names: list) -> Iterator[np.ndarray]:
        """Cell and band numbers for each request of one dimension."""
        matrix, records = pivots[own.shape[1]]
        cosines = own @ matrix.T
        for name, scores in zip(names, cosines):
            least = -1.0 if min_score is None else min_score
            if k is not None:
                best: dict = {}
                for record, score in zip(records, scores.tolist()):
                    if record != name and record is not None:
                        best[record] = max(score, best.get(record, -1.0))
                ranked = sorted(best.values(), reverse=True)
                least = max(least, ranked[k - 1]) if len(ranked) >= k else least
            widest = np.arccos(np.clip(least - SLACK, -1, 1)) + SLACK
            centre = np.arccos(np.clip(scores, -1, 1))
            low, high = _band(np.maximum(centre - widest, 0)), _band(np.minimum(centre + widest, np.pi))
            count = high - low + 1
            cells = np.repeat(np.arange(len(scores)), count)
            yield np.stack([cells, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("request_id").to_pylist()
            for at, own in _by_size(batch.column("query_vector")):
                size = own.shape[1]
                chosen = batch.take(pa.array(at))
                if size in pivots:
                    targets = list(reach(own, [names[i] for i in at]))
                else:
                    targets = [np.array([[-1], [-1]])] * len(at)
                times = [t.shape[1] for t in targets]
                cells, bands = np.concatenate(targets, axis=1)
                again = chosen.take(pa.array(np.repeat(np.arange(len(at)), times)))
                yield pa.RecordBatch.from_arrays(
                    [*again.columns, *(pa.array(c, pa.int32()) for c in (np.full(len(cells), size), cells, bands))],
                    names=[*batch.schema.names, "dim", "cell", "band"],
                )

    kind = rows.schema["request_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"request_id {kind}, query_vector array<double>, dim int, cell int, band int")


PLACE = ["dim", "cell", "band"]


def meetings(vectors: DataFrame, requests: DataFrame, min_score: float | None = None, k: int | None = None) -> DataFrame:
    """Blocks of vectors with the requests that cannot rule them out: columns vectors, requests.

    Vectors without a direction, and of other dimensions than a request, meet nothing.
    """
    vectors, requests = vectors.filter(usable("embedding")), requests.filter(usable("query_vector"))
    pivots = choose_pivots(vectors)
    rows, wanted = placed(vectors, pivots), aimed(requests, pivots, min_score, k)
    # As many rows as there are cells and bands.
    blocks = rows.groupBy(*PLACE).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    packed = (
        rows.join(blocks, PLACE)
        .withColumn("block", F.pmod(F.xxhash64("chunk_id", "record_id"), "blocks").cast("int"))
        .groupBy(*PLACE, "block")
        .agg(F.collect_list(F.struct("record_id", "chunk_id", "embedding")).alias("vectors"))
    )
    met = wanted.join(blocks, PLACE)
    slices = met.groupBy(*PLACE).agg(F.ceil(F.count(F.lit(1)) / REQUEST_ROWS).cast("int").alias("slices"))
    asked = (
        met.join(slices, PLACE)
        .withColumn("slice", F.pmod(F.xxhash64("request_id"), "slices").cast("int"))
        .groupBy(*PLACE, "blocks", "slice")
        .agg(F.collect_list(F.struct("request_id", "query_vector")).alias("requests"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return packed.join(asked, [*PLACE, "block"]).select("vectors", "requests")


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StructArray, pa.StructArray, np.ndarray]]:
    """Vectors, requests and rounded scores (request by vector) of each meeting."""
    for batch in batches:
        for own, asked in zip(batch.column("vectors"), batch.column("requests")):
            own, asked = own.values, asked.values
            (_, left), (_, right) = next(_by_size(asked.field("query_vector"))), next(_by_size(own.field("embedding")))
            yield own, asked, np.round(left @ right.T, SCORE_DIGITS)


def hits(vectors: DataFrame, requests: DataFrame, min_score: float) -> DataFrame:
    """request_id, record_id, chunk_id and score of every pair that scores at least ``min_score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, asked, scores in _products(batches):
            q, v = np.nonzero(scores >= min_score)
            found = own.take(pa.array(v))
            yield pa.RecordBatch.from_arrays(
                [asked.field("request_id").take(pa.array(q)), found.field("record_id"), found.field("chunk_id"), pa.array(scores[q, v])],
                names=["request_id", "record_id", "chunk_id", "score"],
            )

    kinds = vectors.schema["record_id"].dataType.simpleString(), requests.schema["request_id"].dataType.simpleString()
    met = meetings(vectors, requests, min_score=min_score)
    return met.mapInArrow(run, f"request_id {kinds[1]}, record_id {kinds[0]}, chunk_id long, score double")


def nearest_records(vectors: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """request_id, record_id, score, rank: the k best other records of each request.

    A block keeps k records for a request: a record with k better ones in its own best
    block cannot be among the k best of all.  Ties go to the smaller record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, asked, scores in _products(batches):
            records = own.field("record_id").to_pylist()
            names = sorted({r for r in records if r is not None})
            place = {r: i for i, r in enumerate(names)}
            order = np.argsort(np.array([place.get(r, len(names)) for r in records]), kind="stable")
            group = np.array([place.get(records[i], len(names)) for i in order])
            starts = np.searchsorted(group, np.arange(len(names)))
            if not len(names):
                continue
            # Records in order, so that a stable sort by score leaves ties to the smaller one.
            known = scores[:, order[group < len(names)]]
            best = np.maximum.reduceat(known, starts, axis=1)
            out = []
            for request, line in zip(asked.field("request_id").to_pylist(), best):
                if request in place:
                    line[place[request]] = -np.inf
                for i in np.argsort(-line, kind="stable")[:k]:
                    if line[i] > -np.inf:
                        out.append((request, names[i], float(line[i])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["request_id", "record_id", "score"])

    kind = vectors.schema["record_id"].dataType.simpleString()
    met = meetings(vectors, requests, k=k)
    rows = met.mapInArrow(run, f"request_id {kind}, record_id {kind}, score double")
    best = rows.groupBy("request_id", "record_id").agg(F.max("score").alias("score"))
    by_request = Window.partitionBy("request_id").orderBy(F.col("score").desc(), "record_id")
    return best.withColumn("rank", F.row_number().over(by_request)).filter(F.col("rank") <= k)


def scored_pairs(vectors: DataFrame, requests: DataFrame, min_score: float | None = None, k: int | None = None) -> int:
    """How many pairs a search computes: all pairs less what the angles rule out."""
    met = meetings(vectors, requests, min_score, k)
    return met.agg(F.sum(F.size("vectors").cast("long") * F.size("requests"))).first()[0] or 0

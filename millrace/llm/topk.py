"""Exact top-k by columnar branch and bound.

Vectors are turned into whole numbers and packed into blocks with a vertical layout: one
row of the matrix per dimension.  Each query block meets each candidate block in a task.
Scores grow dimension block by dimension block; after each, a candidate whose score plus
the largest possible rest (norm of the query's rest times norm of the candidate's rest)
stays below the k-th score known so far is dropped and the survivors are compacted.

Queries are a stated set of rows.  Each query block first meets one seed block; its k-th
best score there is a floor that every other block starts from.  A block records the
largest norm of its candidates, and a query block is sent only to the blocks in which the
norms still allow the floor of one of its queries; there the candidates that cannot reach a
query's floor are dropped before anything else, and only rows at the floor or above return.

Vectors that are null or hold null or non-finite components take no part.  Vectors only
meet vectors of the same length; empty ones score 0.  A query never meets a row of its own
id.  Ties go to the smaller id.  Rows repeated under one id each take a place; equal query
rows are asked once, and different query vectors under one id share one list.  A table
without queries or candidates gives an empty result; extra columns are ignored.  Scores
must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import bounded, durable

BLOCK_ROWS = 4096  # candidates of one block
QUERY_ROWS = 256  # queries of one block
DIM_STEP = 16
SEED_COPIES = 64  # tasks that share the work on the seed block
PACKED = "dim int, block long, ids binary, matrix binary, reach double"
ASKED = "dim int, asked long, q_ids binary, q_matrix binary, floors binary, need double"
LOCAL = "query_id long, vec_id long, score long"


def whole_numbers(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def pack(rows: DataFrame, limit: int) -> DataFrame:
    """Blocks of at most ``limit`` vectors of one length; no shuffle.  block is unique, reach the largest norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, waiting = TaskContext.get().partitionId() << 40, {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, vectors = waiting.pop(dim)
            matrix = np.array(vectors, np.int64).reshape(len(ids), dim).T
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dim], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([np.ascontiguousarray(narrow(matrix)).tobytes()], pa.binary()),
                    pa.array([float(norms(matrix).max(initial=0))], pa.float64()),
                ],
                names=["dim", "block", "ids", "matrix", "reach"],
            )

        for batch in batches:
            for own, vector in zip(batch.column(0), batch.column(1)):
                values = vector.values.to_numpy(zero_copy_only=False)
                ids, vectors = waiting.setdefault(len(values), ([], []))
                ids.append(own.as_py())
                vectors.append(values)
                if len(ids) >= limit:
                    yield out(len(values))
        for dim in list(waiting):
            yield out(dim)

    return rows.mapInArrow(run, PACKED)


def norms(matrix: np.ndarray) -> np.ndarray:
    """Length of each column, rounded up."""
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(0)) * (1 + 1e-9)


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds every value."""
    most = int(np.abs(matrix).max()) if matrix.size else 0
    kind = next(t for t, m in ((np.int16, 2**15), (np.int32, 2**31), (np.int64, 2**63)) if most < m)
    return matrix.astype(kind)


def unpacked(ids: bytes, matrix: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    cells = max(dim * len(own), 1)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}.get(len(matrix) // cells, np.int16)
    return own, np.frombuffer(matrix, kind).reshape(dim, len(own))


def search(query_ids, queries, ids, columns, k: int, floors=None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best rows of this block; those below its floor may be missing."""
    dim = len(columns)
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(columns).max(initial=0)) * max(dim, 1)
    kind = np.float64 if largest < 2**53 else np.int64  # both exact for the sums they get
    order = np.argsort(-np.var(columns.astype(np.float64), axis=1), kind="stable") if dim else np.arange(0)
    rows = np.ascontiguousarray(columns[order].astype(kind))
    asked = queries[order].astype(kind)
    steps = [(s, min(s + DIM_STEP, dim)) for s in range(0, dim, DIM_STEP)]
    rest_rows = [np.sqrt((rows[e:].astype(np.float64) ** 2).sum(0)) for _, e in steps]
    rest_asked = [np.sqrt((asked[e:].astype(np.float64) ** 2).sum(0)) for _, e in steps]
    partial = asked[: steps[0][1]].T @ rows[: steps[0][1]] if steps else np.zeros((len(query_ids), len(ids)), kind)
    found = []
    for q, own in enumerate(query_ids):
        live = np.flatnonzero(ids != own)
        scores = partial[q, live]
        for n, (start, end) in enumerate(steps):
            if n:
                scores = scores + asked[start:end, q] @ rows[start:end, live]
            if end < dim and kind is np.float64 and (len(live) > k or floors is not None):
                slack = rest_asked[n][q] * rest_rows[n][live] * (1 + 1e-12) + 1e-6
                floor = -np.inf if floors is None else floors[q]
                if len(live) > k:
                    floor = max(floor, np.partition(scores - slack, len(live) - k)[len(live) - k])
                stay = scores + slack >= floor
                live, scores = live[stay], scores[stay]
        if floors is not None:
            stay = scores >= floors[q]
            live, scores = live[stay], scores[stay]
        if len(live) > k:  # everything tied with the k-th stays; ids decide below
            stay = scores >= np.partition(scores, len(live) - k)[len(live) - k]
            live, scores = live[stay], scores[stay]
            best = np.lexsort((ids[live], -scores))[:k]
            live, scores = live[best], scores[best]
        found.append((ids[live], scores.astype(np.int64)))
    return found


def with_floors(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Query blocks with the k-th best score of each query in a seed block, and the least norm they need.

    The seed of a length is the block with the largest norm.  Its floor is kept only where
    floats hold the sums exactly; a query with fewer than k rows in the seed has none.
    """
    seed = candidates.groupBy("dim").agg(F.max_by(F.struct("ids", "matrix"), F.struct("reach", "block")).alias("seed"))
    seed = seed.select("dim", "seed.*", F.explode(F.sequence(F.lit(0), F.lit(SEED_COPIES - 1))).alias("copy"))
    dealt = queries.select(
        "dim", F.col("block").alias("asked"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"),
        F.pmod(F.xxhash64("block"), F.lit(SEED_COPIES)).cast("int").alias("copy"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, need = [], []
            for dim, q_ids, q_matrix, ids, matrix in zip(*(batch.column(c) for c in ("dim", "q_ids", "q_matrix", "ids", "matrix"))):
                own, columns = unpacked(ids.as_py(), matrix.as_py(), dim.as_py())
                asked_ids, asked = unpacked(q_ids.as_py(), q_matrix.as_py(), dim.as_py())
                found = search(asked_ids, asked, own, columns, k)
                least = [int(f[1].min()) if len(f[1]) >= k else None for f in found]
                own_floors = np.array([-np.inf if x is None or abs(x) >= 2**52 else x for x in least], np.float64)
                # score <= norm of the query * norm of the candidate
                floors.append(own_floors.tobytes())
                need.append(float(np.where(own_floors > 0, own_floors / np.maximum(norms(asked), 1e-9), 0).min(initial=np.inf)))
            found = {c: batch.column(c) for c in ("dim", "asked", "q_ids", "q_matrix")}
            yield pa.RecordBatch.from_pydict(found | {"floors": pa.array(floors, pa.binary()), "need": pa.array(need, pa.float64())})

    return dealt.join(seed, ["dim", "copy"]).mapInArrow(run, ASKED)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each query row."""
    spark = bounded(vectors.sparkSession)
    good = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    numbers = good.select("vec_id", whole_numbers(F.col("embedding"), scale).alias("v"), is_query.alias("q"))
    candidates = durable(pack(numbers.select("vec_id", "v"), BLOCK_ROWS))
    queries = pack(numbers.where("q").select("vec_id", "v").distinct(), QUERY_ROWS)
    asked = durable(with_floors(queries, candidates, k))
    # The list of block numbers is split so that no row holds more than a bounded part of it.
    places = candidates.groupBy("dim", (F.col("block") % 64).alias("part")).agg(
        F.collect_list(F.struct("block", "reach")).alias("blocks")
    )
    sent = asked.join(places, "dim").withColumn("place", F.explode("blocks")).where("place.reach >= need")
    sent = sent.select("dim", F.col("place.block").alias("block"), "q_ids", "q_matrix", "floors")
    pairs = candidates.join(sent, ["dim", "block"]).select("dim", "ids", "matrix", "q_ids", "q_matrix", "floors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, matrix, q_ids, q_matrix, floors in zip(*(batch.column(i) for i in range(6))):
                dim = dim.as_py()
                own, columns = unpacked(ids.as_py(), matrix.as_py(), dim)
                asked_ids, asked = unpacked(q_ids.as_py(), q_matrix.as_py(), dim)
                found = search(asked_ids, asked, own, columns, k, np.frombuffer(floors.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(asked_ids, [len(f[0]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found]).astype(np.int64)),
                        pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    local = pairs.mapInArrow(run, LOCAL)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""Audits of quotes that may differ from their source by a few edits.

A quote that is at most k edits from a passage keeps one of any k + 1 pieces of it
unchanged.  So the pieces are looked up in the source, and only around their places, on a
band of k diagonals to either side, is the quote aligned with the source.  A row of the edit
matrix is one vector operation; its left-to-right dependence is a running minimum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEAR_EDITS = 3


def bands(source: str, quote: str, most: int) -> list[tuple[int, int]]:
    """Stretches of the source that can hold the quote with at most ``most`` edits, overlapping ones joined."""
    size = len(quote)
    edges = [size * i // (most + 1) for i in range(most + 2)]
    starts = set()
    for a, b in zip(edges, edges[1:]):
        at = source.find(quote[a:b])
        while at >= 0:
            starts.add(at - a)
            at = source.find(quote[a:b], at + 1)
    out: list[list[int]] = []
    for start in sorted(starts):
        low, high = max(0, start - most), min(len(source), start + size + most)
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def aligned(passage: str, quote: str, most: int) -> tuple[int, int] | None:
    """Least edits from the quote to any part of the passage, and where the first such part ends."""
    text = np.frombuffer(passage.encode("utf-32-le"), np.uint32)
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)  # the part may begin anywhere
    for n, code in enumerate(np.frombuffer(quote.encode("utf-32-le"), np.uint32), 1):
        above = np.minimum(row + 1, n)
        above[1:] = np.minimum(above[1:], row[:-1] + (text != code))
        row = np.minimum.accumulate(above - steps) + steps
        if row.min() > most:
            return None
    end = int(row.argmin())
    return int(row[end]), end


def edits(source: str, quote: str, most: int = NEAR_EDITS) -> tuple[int, int] | None:
    """Least edits between the quote and a part of the source, if at most ``most``, and where that part ends."""
    at = source.find(quote)
    if at >= 0:
        return 0, at + len(quote)
    if len(quote) <= most:
        found = aligned(source, quote, most)
        return found and min(found, (len(quote), 0))
    best = None
    for low, high in bands(source, quote, most):
        found = aligned(source[low:high], quote, most if best is None else best[0])
        if found and (best is None or found[0] < best[0]):
            best = found[0], low + found[1]
    return best


def audit(rows: DataFrame, source: str, quote: str, *keep: str, most: int = NEAR_EDITS) -> DataFrame:
    """Columns ``keep``, ``edits`` (null beyond ``most``) and ``quote_end`` in the source.

    Null quotes and sources have no edits.  The work of a row follows the places where a
    piece of its quote occurs.
    """
    given = rows.select(*keep, F.col(source).alias("_source"), F.col(quote).alias("_quote"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, own in zip(batch.column(len(keep)), batch.column(len(keep) + 1)):
                text, own = text.as_py(), own.as_py()
                found.append(None if text is None or own is None else edits(text, own, most))
            counts = pa.array([f and f[0] for f in found], pa.int32())
            ends = pa.array([f and f[1] for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], counts, ends], names=[*keep, "edits", "quote_end"])

    return given.mapInArrow(run, f"{kinds}edits int, quote_end int")

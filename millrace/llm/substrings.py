"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document.  Words are removed that are covered
by a window which also starts in a document with a smaller id.

Anchors: each document is cut into non-overlapping blocks of ``BLOCK`` words, counted from
its start.  A repeat of 13 words holds a whole block of 7 of the other document wherever it
lies (13 = 2 * 7 - 1), so indexing the blocks and probing them with every rolling window of
7 words meets every repeat.  Hits are then extended: each window of 13 words over a hit is
compared as a whole, and touching windows make up the maximal repeat.

Documents are dealt into groups by a hash of their id and text; a group holds a bounded amount of
text.  Within a group equal hashes are merged before anything is shuffled, and they travel
as packed arrays, one for each (group, bucket).  A passage that is in every document is one
number per group, so no key is hot.  Hashes of 7 words only choose candidates; windows of
13 words are compared by 96 bits of two independent hashes.

A null id is smaller than every other id (repeats under null ids are equal).  Rows that
repeat an id count as one document in the comparison of ids: they keep what no smaller id
has.  Null and empty texts have no words.  Extra columns are ignored; empty tables are fine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import bounded, mix, rolling, run_starts, text_groups, word_hashes

WINDOW, BLOCK = 13, 7
GROUPS_A_BUCKET = 3
NULL_ID = -(2**63)


def words_of(texts: pa.ChunkedArray) -> Iterator[list[bytes]]:
    """The words of one text after the other; no two texts are held as words."""
    for text in texts:
        yield (text.as_py() or "").encode().split()


def group_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents end to end, and where each document begins."""
    parts = [word_hashes(w) for w in words_of(texts)]
    starts = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), starts


def whole_windows(starts: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows lie in one document, and the document of each window."""
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))[:n]
    at = np.arange(n, dtype=np.int32)
    return at + np.int32(width) <= starts[owner + 1] if n else np.empty(0, bool), owner


def anchors(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hashes of BLOCK words: values, places, documents, and whether each is a block of its document."""
    rolled = rolling(hashes, BLOCK)
    good, owner = whole_windows(starts, BLOCK, len(rolled))
    at = np.flatnonzero(good).astype(np.int32)
    return rolled[at], at, owner[at], (at - starts[owner[at]]) % BLOCK == 0


def second_hash(hashes: np.ndarray) -> np.ndarray:
    """32 more bits for each window, from other word hashes."""
    return (rolling(mix(hashes) ^ (hashes >> np.uint64(7)), WINDOW) >> np.uint64(32)).astype(np.uint32)


def pack(bucket_of: np.ndarray, buckets: int, *columns: np.ndarray) -> list[tuple[int, list[bytes]]]:
    """Columns cut by bucket; rows must be sorted by bucket."""
    edges = np.searchsorted(bucket_of, np.arange(buckets + 1))
    return [
        (b, [np.ascontiguousarray(c[edges[b] : edges[b + 1]]).tobytes() for c in columns])
        for b in range(buckets)
        if edges[b] < edges[b + 1]
    ]


def bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """The upper 24 bits choose the bucket, so sorted values are sorted by bucket too."""
    return ((values >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and clean_text, the kept words joined by a space)."""
    bounded(docs.sparkSession)
    groups = text_groups(docs)
    # Hashes take less memory than texts, so a bucket serves several groups.
    buckets = -(-groups // GROUPS_A_BUCKET)
    own = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias("own")
    dealt = docs.select(own, "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("grp"))
    dealt = dealt.repartition(F.col("grp"))

    # 1. Every group: its distinct rolling hashes, and whether they are blocks.
    def probe(key: tuple, table: pa.Table) -> pa.Table:
        hashes, starts = group_words(table["text"])
        values, _, _, block = anchors(hashes, starts)
        order = np.argsort(values, kind="stable")
        values, block = values[order], block[order]
        first = run_starts(values)
        flags = np.logical_or.reduceat(block, first).astype(np.uint8) if len(first) else np.empty(0, np.uint8)
        values = values[first]
        # 30 bits below the bucket bits choose candidates; the lowest of 32 is the flag.
        short = ((values >> np.uint64(8)).astype(np.uint32) & np.uint32(0xFFFFFFFC)) | flags
        return blobs(key[0].as_py(), pack(bucket(values, buckets), buckets, short), ["data"])

    kind = "grp int, bucket int, data binary"
    probes = dealt.groupBy("grp").applyInArrow(probe, kind)

    # 2. Every bucket: hashes that two groups share and one of them has as a block.
    def meet(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint32) for x in table["data"]]
        sizes = [len(p) for p in parts]
        data = np.concatenate(parts)
        source = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        order = np.argsort(data >> np.uint32(2), kind="stable")
        short, flags, source = (data >> np.uint32(2))[order], (data & np.uint32(3))[order], source[order]
        first = run_starts(short)
        count = np.diff(np.append(first, len(short)))
        joined = np.bitwise_or.reduceat(flags, first)
        hit = ((joined & 1) > 0) & (count > 1)
        every = np.repeat(hit, count)
        short, source = short[every], source[every]
        order = np.argsort(source, kind="stable")
        short, source = short[order], source[order]
        grps = table["grp"].to_pylist()
        edges = np.searchsorted(source, np.arange(len(parts) + 1))
        rows = [(grps[i], short[edges[i] : edges[i + 1]].tobytes()) for i in range(len(parts)) if edges[i] < edges[i + 1]]
        return pa.table(
            [
                pa.array([g for g, _ in rows], pa.int32()),
                pa.array([key[0].as_py()] * len(rows), pa.int32()),
                pa.array([d for _, d in rows], pa.binary()),
            ],
            names=["grp", "bucket", "data"],
        )

    hits = probes.groupBy("bucket").applyInArrow(meet, kind)

    # 3. Every group: its distinct windows of 13 words over hits, with their smallest id.
    def extend(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        hashes, starts = group_words(table["text"])
        value, check, owner = candidates(hashes, starts, found)
        ids = table["own"].to_numpy()
        order = np.lexsort((ids[owner], check, value))
        value, check, who = value[order], check[order], ids[owner[order]]
        first = run_starts(value, check)
        packed = pack(bucket(value[first], buckets), buckets, value[first], check[first], who[first])
        return blobs(key[0].as_py(), packed, ["value", "check", "least"])

    def candidates(hashes, starts, found):
        values, at, _, _ = anchors(hashes, starts)
        wanted = np.sort(np.concatenate(
            [np.empty(0, np.uint64)]
            + [np.frombuffer(d.as_py(), np.uint32).astype(np.uint64) | np.uint64(b.as_py()) << np.uint64(30) for b, d in zip(found["bucket"], found["data"])]
        ))
        short = bucket(values, buckets).astype(np.uint64) << np.uint64(30) | (values >> np.uint64(10)) & np.uint64(0x3FFFFFFF)
        place = np.searchsorted(wanted, short)
        hit = np.zeros(len(hashes) + 1, np.int64)
        if len(wanted):
            hit[at[wanted[np.minimum(place, len(wanted) - 1)] == short] + 1] = 1
        total = np.cumsum(hit)
        rolled = rolling(hashes, WINDOW)
        good, owner = whole_windows(starts, WINDOW, len(rolled))
        where = np.arange(len(rolled))
        over = total[where + WINDOW - BLOCK + 1] > total[where] if len(where) else np.empty(0, bool)
        chosen = np.flatnonzero(good & over)
        return rolled[chosen], second_hash(hashes)[chosen], owner[chosen]

    kind = "grp int, bucket int, value binary, check binary, least binary"
    spread = dealt.groupBy("grp").cogroup(hits.groupBy("grp")).applyInArrow(extend, kind)

    # 4. Every bucket: windows of which another group has a smaller id go back to the group.
    def settle(key: tuple, table: pa.Table) -> pa.Table:
        read = lambda c, t: [np.frombuffer(x.as_py(), t) for x in table[c]]
        parts = read("value", np.uint64)
        value, check = np.concatenate(parts), np.concatenate(read("check", np.uint32))
        least = np.concatenate(read("least", np.int64))
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort((least, check, value))
        value, check, least, source = value[order], check[order], least[order], source[order]
        first = run_starts(value, check)
        count = np.diff(np.append(first, len(value)))
        larger = least > np.repeat(least[first], count)
        value, check, source = value[larger], check[larger], source[larger]
        order = np.argsort(source, kind="stable")
        value, check = value[order], check[order]
        edges = np.searchsorted(source[order], np.arange(len(parts) + 1))
        grps = table["grp"].to_pylist()
        cuts = [(g, slice(edges[i], edges[i + 1])) for i, g in enumerate(grps) if edges[i] < edges[i + 1]]
        return pa.table(
            [
                pa.array([g for g, _ in cuts], pa.int32()),
                pa.array([key[0].as_py()] * len(cuts), pa.int32()),
                pa.array([value[s].tobytes() for _, s in cuts], pa.binary()),
                pa.array([check[s].tobytes() for _, s in cuts], pa.binary()),
            ],
            names=["grp", "bucket", "value", "check"],
        )

    settled = spread.groupBy("bucket").applyInArrow(settle, "grp int, bucket int, value binary, check binary")

    # 5. Every group: cover the words of windows that a smaller id has, in another group or in this one.
    def cover(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        hashes, starts = group_words(table["text"])
        ids = table["own"].to_numpy()
        rolled, second = rolling(hashes, WINDOW), second_hash(hashes)
        good, owner = whole_windows(starts, WINDOW, len(rolled))
        at = np.flatnonzero(good)
        own, who = rolled[at], ids[owner[at]]
        value = np.concatenate([np.empty(0, np.uint64)] + [np.frombuffer(x.as_py(), np.uint64) for x in found["value"]])
        check = np.concatenate([np.empty(0, np.uint32)] + [np.frombuffer(x.as_py(), np.uint32) for x in found["check"]])
        # What came back is sorted in with an id below all others; then the first row of a run has the smallest id.
        every = np.concatenate([value, own])
        seconds = np.concatenate([check, second[at]])
        owners = np.concatenate([np.full(len(value), np.iinfo(np.int64).min), who])
        foreign = np.concatenate([np.ones(len(value), bool), np.zeros(len(own), bool)])
        order = np.lexsort((owners, ~foreign, seconds, every))
        first = run_starts(every[order], seconds[order])
        count = np.diff(np.append(first, len(order)))
        lead = order[first]
        smaller = np.repeat(foreign[lead], count) | (np.repeat(owners[lead], count) < owners[order])
        start = at[order[smaller & ~foreign[order]] - len(value)]
        gone = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(gone, start, 1)
        np.add.at(gone, start + WINDOW, -1)
        removed = np.cumsum(gone)[:-1] > 0
        digests, sizes, lost, out_text = [], [], [], []
        for i, own_words in enumerate(words_of(table["text"])):
            mask = removed[starts[i] : starts[i + 1]]
            cut = int(mask.sum())
            left = own_words if not cut else [w for w, m in zip(own_words, mask.tolist()) if not m]
            kept = b" ".join(left)
            digests.append(hashlib.sha256(kept).hexdigest())
            if keep_text:
                out_text.append(kept)
            sizes.append(len(own_words))
            lost.append(cut)
        columns = {
            "doc_id": pa.array([None if i == NULL_ID else i for i in ids.tolist()], pa.int64()),
            "n_words": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if keep_text:
            columns["clean_text"] = pa.array(out_text, pa.binary()).cast(pa.string())
        return pa.table(columns)

    result = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", clean_text string" * keep_text
    return dealt.groupBy("grp").cogroup(settled.groupBy("grp")).applyInArrow(cover, result)


def blobs(group: int, packed: list[tuple[int, list[bytes]]], names: list[str]) -> pa.Table:
    return pa.table(
        [pa.array([group] * len(packed), pa.int32()), pa.array([b for b, _ in packed], pa.int32())]
        + [pa.array([c[i] for _, c in packed], pa.binary()) for i in range(len(names))],
        names=["grp", "bucket", *names],
    )

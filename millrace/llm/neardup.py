"""MinHash near-duplicates by a multi-index Hamming join.

Each distinct set of word shingles gets a signature of 60 minhashes of 8 bits.  Signatures
are cut into 10 chunks of 6; two signatures that differ in at most 19 places have a chunk
with at most one difference (pigeonhole).  Every chunk is therefore indexed under 6 keys,
each with one place left out: all pairs under that distance share a key.  A pair with a
similarity of 0.8 shares none with a chance of 0.345 ** 10, about 2 in 100,000.

Documents with equal sets are one class with one entry in the index.  The pairs of a key
are never all made.  Every member of a key is compared, on full sets, with the key's first and
last class; where the members of a key still lie in several components, the pairs between
components that two bounds do not rule out are checked one by one, each pair at the first
key that it shares.  So no link is lost and a group of near copies costs some checks per
member.  Sets are read again for the classes that have a pair, found by a bitmap of fixed size.

Shingles are distinct runs of words after A-Z is lower-cased; with fewer words the whole
sequence is one.  Without words (or text) the set is empty and linked with nothing.  A null
id counts as the smallest.  Rows that repeat an id and its text stay together; rows that
repeat an id with another text are documents of their own.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import (
    arrow_pass, bounded, durable, id_bit, id_bitmap, in_bitmap, mix, rolling, texts_of, word_hashes,
)
from millrace.llm.components import components

CHUNKS, PER_CHUNK = 10, 6
PLACES = CHUNKS * PER_CHUNK
NULL_ID = -(2**63)
SALTS = 32
# Odd multipliers of the minhashes, from a fixed stream.
FACTORS = mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
COLUMNS = [f"c{i}" for i in range(CHUNKS)]
# An outline has one bit for each residue of the shingle hashes, in 16 numbers.
OUTLINE = [f"o{i}" for i in range(16)]


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    hashes = word_hashes(text.encode().lower().split())
    return np.unique(rolling(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def signature(own: np.ndarray) -> np.ndarray:
    """One number of 48 bits for each chunk: 6 minhashes of 8 bits."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(own), 4096):
        np.minimum(least, (own[None, s : s + 4096] * FACTORS[:, None]).min(1), out=least)
    cells = (mix(least) & np.uint64(0xFF)).reshape(CHUNKS, PER_CHUNK)
    return (cells << (np.uint64(8) * np.arange(PER_CHUNK, dtype=np.uint64))).sum(1).astype(np.int64)


def class_of(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63


def text_key(text: str) -> bytes:
    """128 bits for a text; null counts as empty."""
    return xxhash.xxh3_128_digest(text.encode())


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, own, n_shingles, node (the class), text_key and the chunks of the signature."""
    source = docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("own"), "text")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            sets, keys = [], []
            for text in texts_of(batch.column(2)):
                sets.append(shingles(text, width))
                keys.append(text_key(text))
            chunks = np.array([signature(s) for s in sets]).reshape(len(sets), CHUNKS)
            columns = {"doc_id": batch.column(0), "own": batch.column(1)}
            columns |= {"n_shingles": pa.array([len(s) for s in sets], pa.int64())}
            columns |= {"node": pa.array([class_of(s) for s in sets], pa.int64()), "text_key": pa.array(keys, pa.binary())}
            return columns | {c: pa.array(chunks[:, i]) for i, c in enumerate(COLUMNS)}

        return run

    kind = "doc_id long, own long, n_shingles long, node long, text_key binary, " + ", ".join(f"{c} long" for c in COLUMNS)
    return arrow_pass(source, kind, make)


def index_keys():
    """The keys of a signature: each chunk with each place left out."""
    keys = [
        F.xxhash64(F.lit(i), F.col(COLUMNS[i // PER_CHUNK]).bitwiseAND(~(0xFF << 8 * (i % PER_CHUNK)) & (2**48 - 1)))
        for i in range(PLACES)
    ]
    return F.array(*keys)


SEVENS, EIGHTS = 0x7F7F7F7F7F7F, 0x808080808080


def earlier(number, chunks):
    """Columns of a member that tell whether a pair shares a key with a smaller number than its own.

    ``before`` has the chunks before the number's own; any with at most one place that differs
    has a common key.  ``mine`` is the own chunk unless its first place is the one left out: if
    two members agree in all of it, its first key is the first common one.
    """
    chunk = F.floor(number / PER_CHUNK).cast("int")
    mine = F.when(number % PER_CHUNK > 0, F.element_at(chunks, chunk + 1))
    return F.slice(chunks, F.lit(1), chunk).alias("before"), mine.alias("mine")


def shared_before():
    """Whether rows x and y, which share a key, share one with a smaller number.

    Written over arrays, not as one term for each chunk: as terms, the join's loop became one
    method whose compilation took 360 MB of each executor.
    """
    def close(a, b):
        differ = a.bitwiseXOR(b)  # one mark for each place that differs
        return F.bit_count((differ.bitwiseAND(SEVENS) + SEVENS).bitwiseOR(differ).bitwiseAND(EIGHTS)) <= 1

    inside = F.coalesce(F.col("x.mine") == F.col("y.mine"), F.lit(False))
    return inside | F.coalesce(F.exists(F.zip_with("x.before", "y.before", close), lambda c: c), F.lit(False))


class Sets:
    """Full sets of the classes that are to be compared, read once and kept in the shared folder."""

    def __init__(self, docs: DataFrame, reps: DataFrame, width: int):
        bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(reps))
        own = F.coalesce("doc_id", F.lit(NULL_ID))
        source = docs.select(id_bit(own).alias("bit"), "text")

        def make():
            bits = bitmap.value

            def run(batch: pa.RecordBatch) -> dict:
                mask = in_bitmap(bits, batch.column(0).to_numpy())
                chosen = batch.filter(pa.array(mask))
                sets = [shingles(t, width) for t in texts_of(chosen.column(1))]
                return {
                    "node": pa.array([class_of(s) for s in sets], pa.int64()),
                    "cells": pa.array([short_cells(s) for s in sets], pa.binary()),
                }

            return run

        found = arrow_pass(source, "node long, cells binary", make)
        self.table = durable(found.groupBy("node").agg(F.first("cells").alias("cells")))

    def check(self, pairs: DataFrame, percent: int) -> DataFrame:
        """a, b, both, linked for pairs (node, other) of classes; ``both`` is the size of the intersection."""
        right = self.table.select(F.col("node").alias("other"), F.col("cells").alias("with"))
        joined = pairs.join(self.table, "node").join(right, "other")

        def make():
            def run(batch: pa.RecordBatch) -> dict:
                sets = zip(batch.column("cells"), batch.column("with"))
                found = [common(long_cells(x.as_py()), long_cells(y.as_py())) for x, y in sets]
                linked = [100 * both >= percent * (x + y - both) for both, x, y in found]
                return {
                    "a": batch.column("node"),
                    "b": batch.column("other"),
                    "both": pa.array([f[0] for f in found], pa.int64()),
                    "linked": pa.array(linked, pa.bool_()),
                }

            return run

        kind = "a long, b long, both long, linked boolean"
        return arrow_pass(joined.select("node", "other", "cells", "with"), kind, make)

    def outlines(self, members: DataFrame) -> DataFrame:
        """node and the outline of its set, for the classes of ``members``."""
        classes = self.table.join(members.select("node").distinct(), "node")

        def make():
            def run(batch: pa.RecordBatch) -> dict:
                rows = np.array([outline(long_cells(x.as_py())) for x in batch.column("cells")])
                return {"node": batch.column("node")} | {c: pa.array(rows[:, i]) for i, c in enumerate(OUTLINE)}

            return run

        kind = "node long, " + ", ".join(f"{c} long" for c in OUTLINE)
        return arrow_pass(classes.select("node", "cells"), kind, make)


def short_cells(own: np.ndarray) -> bytes:
    """The upper 48 bits of each hash; two shingles of a pair of sets agree in them once in 10**8 pairs."""
    return np.ascontiguousarray((own >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def long_cells(data: bytes) -> np.ndarray:
    cells = np.zeros((len(data) // 6, 8), np.uint8)
    cells[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return cells.view(np.uint64).ravel()


def outline(cells: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * len(OUTLINE), np.uint8)
    bits[cells % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64)


def common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Size of the intersection, and of both sets."""
    return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The component of each document.

    doc_id, n_shingles, component_id (smallest id reachable), kept, class_id (smallest id with
    an equal set), root (one number for each component; null without words) and text_key.
    """
    bounded(docs.sparkSession)
    signed = durable(signatures(docs, width))
    own = [F.first(c).alias(c) for c in ("n_shingles", *COLUMNS)]
    nodes = durable(signed.where("n_shingles > 0").groupBy("node").agg(F.min("own").alias("rep"), *own))

    keyed = nodes.select("node", "rep", F.posexplode(index_keys()).alias("number", "key"))
    ends = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("size"))
    members = durable(keyed.join(ends.where("size > 1"), "key"))
    others = F.when(F.col("size") > 2, F.array("first", "last")).otherwise(F.array("first"))
    pairs = members.select("node", F.explode(others).alias("other")).where("node != other")
    pairs = durable(pairs.distinct())
    sets = Sets(docs, members.select(F.col("rep").alias("id")), width)
    checked = durable(sets.check(pairs, percent))
    roots = components(checked.where("linked"))
    open_members = durable(unresolved(members.where("size > 2"), roots))
    if not open_members.isEmpty():
        rest = remaining_pairs(open_members, nodes, sets.outlines(open_members), checked, percent)
        found = sets.check(durable(rest), percent).where("linked").select("a", "b")
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.union(found))

    placed = nodes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    placed = durable(placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))))
    # A component may hold a third of all classes, so its smallest id is joined by root and salt.
    smallest = placed.groupBy("root").agg(F.min("rep").alias("least"), F.count("*").alias("size")).where("size > 1")
    smallest = smallest.select("root", "least", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    final = placed.join(smallest, ["root", "salt"], "left")
    final = final.select("node", "root", F.coalesce("least", "rep").alias("least"), F.col("rep").alias("class_rep"))
    joined = signed.join(final, "node", "left")
    least = F.coalesce("least", "own")
    back = lambda c: F.when(c != NULL_ID, c)
    return joined.select(
        "doc_id",
        "n_shingles",
        back(least).alias("component_id"),
        (F.col("own") == least).alias("kept"),
        back(F.coalesce("class_rep", "own")).alias("class_id"),
        "root",
        "text_key",
    )


def unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of the keys whose members have more than one."""
    own = members.select("key", "number", "node", "first")
    placed = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return placed.join(mixed.select("key"), "key", "left_semi")


def remaining_pairs(members: DataFrame, nodes: DataFrame, outlines: DataFrame, checked: DataFrame, percent: int) -> DataFrame:
    """Pairs between components of a key that were not checked, each at the first key that it shares.

    Pairs that cannot reach the wanted similarity are left out, by two bounds.  Both members
    were compared with the key's first class p, so they have at most min(|x & p|, |y & p|) +
    min(|x - p|, |y - p|) shingles in common; and every bit in which their outlines differ
    stands for a shingle that only one of them has.
    """
    known = checked.select(F.col("a").alias("node"), F.col("b").alias("first"), "both").distinct()
    full = members.join(nodes.select("node", "n_shingles", F.array(*COLUMNS).alias("chunks")), "node").join(outlines, "node")
    full = full.join(known, ["node", "first"], "left")
    full = full.withColumn("both", F.when(F.col("node") == F.col("first"), F.col("n_shingles")).otherwise(F.col("both")))
    full = full.withColumn("inside", F.coalesce("both", "n_shingles")).withColumn("outside", F.coalesce(F.col("n_shingles") - F.col("both"), "n_shingles"))
    # None of these is null; saying so keeps the join's condition short.
    used = ["node", "root", "n_shingles", "inside", "outside", *OUTLINE]
    full = full.select("key", *earlier(F.col("number"), F.col("chunks")), *[F.coalesce(c, F.lit(0)).alias(c) for c in used])
    x, y = full.alias("x"), full.alias("y")
    sizes = F.col("x.n_shingles") + F.col("y.n_shingles")
    most = F.least("x.inside", "y.inside") + F.least("x.outside", "y.outside")
    apart = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in OUTLINE), F.lit(0))
    fits = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.root") != F.col("y.root"))
        & (100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles"))
        & (100 * most >= percent * (sizes - most))
        # With at most (sizes - apart) / 2 shingles in common, at least (sizes + apart) / 2 are in the union.
        & (100 * (sizes - apart) >= percent * (sizes + apart))
        & ~shared_before()
    )
    pairs = x.join(y, fits).select(F.col("x.node").alias("node"), F.col("y.node").alias("b"))
    done = checked.select(F.least("a", "b").alias("node"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(done, ["node", "b"], "left_anti").select("node", F.col("b").alias("other"))


def drop_copies(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """One document of each component of ``judged``, the result of ``near_duplicates``.

    The one with the smallest id stays; among texts under that id, the one of the smallest
    key.  Documents are told apart by id and text, so a text under a repeated id goes only
    with its own component, and rows that repeat both are one document and stay together.
    A null id names no document: of equal texts under it one stays.  Rows whose id is not in
    a bitmap of dropped ids pass at once.
    """
    own = lambda c: F.coalesce(c, F.lit(NULL_ID))
    rows = judged.select(own("doc_id").alias("__own"), F.col("text_key").alias("__key"), "root", "kept")
    repeated = durable(rows.groupBy("__own").agg(F.count("*").alias("n")).where("n > 1").select("__own"))
    rivals = rows.where(F.col("kept") & F.col("root").isNotNull()).join(repeated, "__own", "left_semi")
    # Kept texts of one component have the same id; few ids repeat, and copies fold to one row.
    rivals = rivals.select("root", "__own", "__key").distinct()
    winners = rivals.groupBy("root").agg(F.min("__key").alias("first"))
    losers = rivals.join(winners, "root").where(F.col("__key") != F.col("first")).select("__own", "__key")
    gone = durable(rows.where(~F.col("kept")).select("__own", "__key").unionByName(losers).distinct())
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(gone.select(F.col("__own").alias("id"))))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    marked = docs.withColumn("__bit", id_bit(own("doc_id")))
    names = docs.columns

    def part(rows: DataFrame, inside: bool | None) -> DataFrame:
        """Rows in the bitmap or not, or all of them; the keys of the texts unless they pass."""

        def make():
            bits = bitmap.value

            def run(batch: pa.RecordBatch) -> dict:
                mask = in_bitmap(bits, batch.column("__bit").to_numpy())
                chosen = batch if inside is None else batch.filter(pa.array(mask == inside))
                found = {c: chosen.column(c) for c in names}
                if inside is not False:
                    found["__key"] = pa.array([text_key(t) for t in texts_of(chosen.column("text"))], pa.binary())
                return found

            return run

        return arrow_pass(rows, kinds + ("" if inside is False else ", `__key` binary"), make)

    named, nameless = marked.where("doc_id IS NOT NULL"), marked.where("doc_id IS NULL")
    left = part(named, True).unionByName(part(nameless, None).dropDuplicates(["__key"]))
    left = left.withColumn("__own", own("doc_id")).join(gone, ["__own", "__key"], "left_anti")
    return part(named, False).unionByName(left.select(*names))

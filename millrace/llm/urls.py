"""URL filters by a sort-merge range join.

A rule (host, path, action) fits its host and every subdomain when the page's path starts
with the rule's path.  With the labels of a host reversed ("net.example.") each rule is an
interval of keys, and intervals nest or are disjoint.  Pages are range-partitioned by key;
a sorted sweep in each partition keeps a stack of the intervals that are open.  A rule goes
to every partition that its interval meets, found from the partitions' first and last keys;
rules and pages pass the sweep as one sorted stream of rows.

The longest rule wins (host and path together; then the longer host, then the text, then
"allow").  Pages that no rule fits get the default verdict.  Null urls and urls without
"://" have an empty host and path and fit no rule.  Rules without a host fit nothing.
Repeated rows repeat; extra columns are ignored; empty tables of pages or rules are fine.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import bounded, durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = "\U0010ffff"
RESULT = "page_id long, host string, path string, rule string, verdict string"


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "/", 1)
    found = F.translate(F.regexp_extract(rest, r"(?s)^[^?#]*", 0), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), found).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), found).otherwise(F.lit(""))


def key_of(host: Column) -> Column:
    """Labels from the last to the first, each with a dot behind it; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    )


class Sweep:
    """Rows in key order: rules open intervals, pages are judged by the intervals around them."""

    def __init__(self, default: str):
        self.default, self.part, self.stack = default, None, []

    def move(self, part: int, key: str) -> None:
        """Close the intervals that do not hold the key."""
        if part != self.part:
            self.part, self.stack = part, []
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, part: int, key: str, path: str, name: str, action: str) -> None:
        self.move(part, key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, set()))
        _, paths, lengths = self.stack[-1]
        lengths.add(len(path))
        # Rules may repeat a host in other letters, or a host and path with another action.
        rules = [paths[path], (name, action)] if path in paths else [(name, action)]
        paths[path] = min(rules, key=lambda r: (r[0], r[1] != "allow"))

    def judge(self, part: int, key: str, path: str) -> tuple[str | None, str]:
        self.move(part, key)
        best = None
        for _, paths, lengths in self.stack:
            # The longest path of a host gives its longest rule.
            for length in sorted(lengths, reverse=True):
                found = paths.get(path[:length]) if length <= len(path) else None
                if found:
                    rank = (-len(found[0]), length, found[0], found[1] != "allow")
                    best = min(best, (rank, found), key=lambda x: x[0]) if best else (rank, found)
                    break
        return best[1] if best else (None, self.default)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages`` (page_id, url)."""
    bounded(pages.sparkSession)
    url = F.col("url")
    keyed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    keyed = keyed.select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path")
    ).withColumn("key", key_of(F.col("host")))
    # page_id is part of the order, so a host with very many pages spreads over partitions.
    ordered = durable(keyed.repartitionByRange("key", "path", "page_id").sortWithinPartitions("key", "path", "page_id"))
    numbered = ordered.withColumn("part", F.spark_partition_id())
    # Two keys for each partition; as many rows as there are partitions.
    edges = sorted(tuple(r) for r in numbered.groupBy("part").agg(F.min("key"), F.max("key")).collect())
    firsts, lasts = [e[1] for e in edges], [e[2] for e in edges]
    parts = [e[0] for e in edges]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for prefix, path, name, action in zip(*(batch.column(i).to_pylist() for i in range(4))):
                low, high = bisect_left(lasts, prefix), bisect_right(firsts, prefix + TOP)
                out += [(parts[i], prefix, path, name, action) for i in range(low, high)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int32(), *[pa.string()] * 4])],
                names=["part", "prefix", "path", "name", "action"],
            )

    host = F.translate(F.col("host"), UPPER, LOWER)
    sent = (
        rules.where(host.isNotNull() & (host != "") & F.col("action").isNotNull())
        .select(
            key_of(host).alias("prefix"),
            F.coalesce("path", F.lit("")).alias("path"),
            F.concat(F.col("host"), F.coalesce("path", F.lit(""))).alias("name"),
            "action",
        )
        .distinct()
        .mapInArrow(spread, "part int, prefix string, path string, name string, action string")
    )
    # Rules stand before the pages of an equal key.  Nothing but the open intervals is held.
    rows = sent.select("part", F.col("prefix").alias("key"), F.lit(False).alias("page"), F.lit(None).cast("long").alias("page_id"),
                       F.lit("").alias("host"), "path", "name", "action")
    rows = rows.unionByName(numbered.withColumn("page", F.lit(True)), allowMissingColumns=True)
    merged = rows.repartition("part").sortWithinPartitions("part", "key", "page")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Sweep(default)
        for batch in batches:
            pages, verdicts = batch.column("page").to_pylist(), []
            columns = (batch.column(c).to_pylist() for c in ("part", "key", "path", "name", "action"))
            for page, part, key, path, name, action in zip(pages, *columns):
                if page:
                    verdicts.append(state.judge(part, key, path))
                else:
                    state.open(part, key, path, name, action)
            own = batch.filter(batch.column("page"))
            found = {c: own.column(c) for c in ("page_id", "host", "path")}
            found |= {c: pa.array([v[i] for v in verdicts], pa.string()) for i, c in enumerate(("rule", "verdict"))}
            yield pa.RecordBatch.from_pydict(found)

    return merged.mapInArrow(sweep, RESULT)

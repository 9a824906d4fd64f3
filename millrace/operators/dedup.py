"""Record lookup, version dedup and the processed-version ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def newest_per_id(df: DataFrame, key: str, version: str, tie: str, *payload: str) -> DataFrame:
    """Newest row per id.  ``max_by`` combines before the shuffle, so an id that holds
    a large part of the table still arrives as one row per input partition."""
    order = F.struct(version, tie)
    return df.groupBy(key).agg(
        F.max_by(F.struct(version, tie, *payload), order).alias("newest"), F.count(F.lit(1)).alias("n_seen")
    ).select(key, "newest.*", "n_seen")


def lookup_latest(events: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Current record of every announced id.

    Announcements are reduced to distinct ids first: whatever number of events an id
    has, the join sees it once, and the event payload is never carried along.
    """
    return snapshot.join(events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events")), key)


def missing_records(events: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    ids = events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"))
    return ids.join(snapshot.select(key), key, "left_anti")


def is_new_version(version: Column, last: Column) -> Column:
    return last.isNull() | (version > last)


def with_last_version(records: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return records.join(ledger.select(key, F.col("version").alias("last_version")), key, "left")


def skip_seen(records: DataFrame, ledger: DataFrame, key: str, version: str) -> DataFrame:
    """Records never processed, or modified after their last processed version."""
    known = with_last_version(records, ledger, key)
    return known.filter(is_new_version(F.col(version), F.col("last_version"))).drop("last_version")


def advance_ledger(ledger: DataFrame, published: DataFrame, key: str, version: str) -> DataFrame:
    """Ledger after a run: only published versions count, and a version never goes back."""
    rows = ledger.select(key, "version").unionByName(published.select(key, F.col(version).alias("version")))
    return rows.groupBy(key).agg(F.max("version").alias("version"))


def resolve_items(items: DataFrame, dimension: DataFrame, item_key: str) -> DataFrame:
    """Item rows with the detail of the item they refer to (unresolved ones stay)."""
    return items.join(dimension, item_key, "left")


def fold_copies(rows: DataFrame) -> DataFrame:
    """Equal rows as one row with a number of copies, combined before the shuffle."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def nest_items(rows: DataFrame, key: str, order: list[str], fields: list[str], segment: Column) -> DataFrame:
    """Ordered item lists, one per (record, segment), from rows whose copies are folded.

    A record with very many items gives several lists, one per stretch of positions,
    instead of one cell of unbounded size; a line repeated without end is one entry.
    """
    return (
        rows.withColumn("segment", segment)
        .groupBy(key, "segment")
        .agg(F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("items"))
    )


def lookup_error_text(title: Column, detail: Column, status: Column, source: str = "Record API") -> Column:
    """Readable text of a failed lookup, from its problem document or its status."""
    name = F.nullif(title, F.lit(""))
    more = F.nullif(detail, F.lit(""))
    told = F.concat(
        F.lit(f"{source} request failed: "),
        F.coalesce(name, F.lit("Unknown error")),
        F.lit(": "),
        F.coalesce(more, F.lit("")),
    )
    return F.when(
        name.isNotNull() | more.isNotNull(), F.regexp_replace(told, r"[: ]+\z", "")
    ).otherwise(F.concat(F.lit(f"{source} request failed with status "), status.cast("string")))


def lookup_errors(problems: DataFrame, body: str, status: str, *keep: str) -> DataFrame:
    doc = F.from_json(F.col(body), "struct<title:string,detail:string>")
    return problems.withColumn("problem", doc).select(
        *keep, lookup_error_text(F.col("problem.title"), F.col("problem.detail"), F.col(status)).alias("error_text")
    )



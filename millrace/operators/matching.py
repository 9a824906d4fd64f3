"""Records by overlap of their items with a supplied item set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GARNISH = "garnishment"


def overlap_counts(items: DataFrame, supplied: DataFrame) -> DataFrame:
    """Counts per record: its items, those supplied, those missing, missing garnishes.

    ``items`` has record_id, item_id, application; ``supplied`` has item_id.  Repeats of
    an item in a record collapse first (combined before the shuffle), so neither a
    record with many lines nor an item in many records is carried row by row.  Whether
    the supplied set is broadcast is left to its measured size.
    """
    distinct_items = items.groupBy("record_id", "item_id").agg(
        F.max(F.col("application") == GARNISH).alias("is_garnish")
    )
    marks = supplied.select("item_id").distinct().withColumn("supplied", F.lit(True))
    marked = distinct_items.join(marks, "item_id", "left").withColumn("missing", F.col("supplied").isNull())
    return marked.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(~F.col("missing")).alias("n_matched"),
        F.count_if("missing").alias("n_unmatched"),
        F.count_if(F.col("missing") & F.col("is_garnish")).alias("n_missing_garnish"),
    )


def missing_for_filter(ignore_missing_garnish: bool = False) -> Column:
    """The missing count that filters use; the reported counts never change."""
    missing = F.col("n_unmatched")
    return missing - F.col("n_missing_garnish") if ignore_missing_garnish else missing


def coverage_bucket(missing: Column) -> Column:
    return (
        F.when(missing == 0, "exact")
        .when(missing == 1, "missing_1")
        .when(missing == 2, "missing_2")
        .otherwise("missing_3_plus")
    )


def overlap_match(
    counts: DataFrame,
    minimum: int = 1,
    coverage: list[str] | None = None,
    ignore_missing_garnish: bool = False,
) -> DataFrame:
    """Records with enough matches, or with nothing missing, inside the chosen buckets."""
    missing = missing_for_filter(ignore_missing_garnish)
    found = counts.filter((F.col("n_matched") >= minimum) | (missing == 0)).withColumn(
        "coverage", coverage_bucket(missing)
    )
    if coverage and "all" not in coverage:
        found = found.filter(F.col("coverage").isin(*coverage))
    return found

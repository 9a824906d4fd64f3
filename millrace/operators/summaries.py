"""Summaries over several levels at once, and sketches that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12  # a distinct count errs by about 1.6 percent
KLL_SIZE = 200  # a rank errs by about 1.65 percent


def count_levels(rows: DataFrame, keys: Sequence[str], levels: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Counts for each grouping set of ``keys`` (all of them, if no levels are given).

    ``level`` is the grouping id: a bit for each key, the first one highest, set where the
    row sums over that key.  A key that is null in the data stays apart from a key that is
    summed over.  One aggregation with a map-side half makes all levels.
    """
    given = rows.cube(*keys) if levels is None else rows.groupingSets([[F.col(c) for c in s] for s in levels], *keys)
    return given.agg(F.grouping_id(*keys).cast("int").alias("level"), F.count(F.lit(1)).alias("n"))


def sketch(rows: DataFrame, keys: Sequence[str], item: str, value: str) -> DataFrame:
    """Per key: number of rows, a sketch of the distinct items and one of the values."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(item, HLL_BITS).alias("items"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_SIZE).alias("values"),
    )


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of several runs or of finer keys as one per key; no row is read again."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("items").alias("items"), F.kll_merge_agg_double("values").alias("values")
    )


def distinct(items: str = "items") -> Column:
    return F.hll_sketch_estimate(items)


def quantile(share: float, values: str = "values") -> Column:
    return F.kll_sketch_get_quantile_double(values, F.lit(share))

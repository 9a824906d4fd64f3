"""Help for writing plans whose costly columns are computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a one-row generator.

    Catalyst copies a projected expression into every filter and expression above it,
    so a parse or a regex chain would run once per use.  A generator's output is not
    copied; this keeps the map-only plan and its whole-stage code, and runs each
    column exactly once per row.
    """
    made = F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], made)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that several places of an expression read, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))

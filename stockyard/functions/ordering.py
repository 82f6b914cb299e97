"""Sort keys with the null order written out, and optional row limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def descending(name: str) -> Column:
    """Largest first; unknown values sort ahead of every known one."""
    return F.col(name).desc_nulls_first()


def top(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Sorted rows, cut to ``limit`` if given."""
    ranked = df.orderBy(*order)
    return ranked if limit is None else ranked.limit(limit)


def some(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Rows in no promised order; with a limit, the first ones of a documented total order."""
    return df if limit is None else df.orderBy(*order).limit(limit)

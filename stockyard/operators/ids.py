"""New ids that continue a table's highest one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.operators.positions import SLOT, with_positions


def last_id(rows: DataFrame, column: str) -> Column:
    return F.coalesce(rows.agg(F.max(column)).scalar(), F.lit(0)).cast("bigint")


def assign_ids(new_rows: DataFrame, column: str, existing: DataFrame, *order: Column) -> DataFrame:
    """Add ``column``: consecutive ids after the existing ones, in the given order."""
    placed = with_positions(new_rows, *order)
    return placed.withColumn(column, last_id(existing, column) + F.col("position")).drop("position", SLOT)

"""Distinct counts that add up: exact bitmaps of ids by month, combined by bitwise or for any range of months.

COUNT(DISTINCT id) of a range cannot be summed from months, bitmaps can. A month holds, for each measure, a bitmap for every
32,768 ids of which one occurs; a range reads the bitmaps of its months alone and never the facts. A month whose facts
changed is written anew without the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.functions.dates import month_of

#: measure -> (id, condition) over sales orders
SALES_MEASURES = {
    "customers": ("customer_id", "true"),
    "employees": ("employee_id", "true"),
    "orders": ("so_id", "true"),
    "active_customers": ("customer_id", "status <> 'cancelled'"),
    "cancelling_customers": ("customer_id", "status = 'cancelled'"),
}
_STORED = "measure string, piece bigint, ids binary, month date"


def month_bitmaps(rows: DataFrame, on: str, measures: Mapping[str, tuple[str, str]] = SALES_MEASURES) -> DataFrame:
    """Bitmaps (month, measure, piece, ids) of rows dated by ``on``; ids that are NULL and rows without a date count nowhere.

    One shuffle of bitmaps that every task has filled for itself, however often an id occurs.
    """
    ids = [
        F.struct(F.lit(name).alias("measure"), F.expr(f"case when {test} then cast({column} as bigint) end").alias("id"))
        for name, (column, test) in measures.items()
    ]
    told = rows.select(month_of(on).alias("month"), F.inline(F.array(*ids))).filter("id is not null and month is not null")
    return told.groupBy("month", "measure", F.bitmap_bucket_number("id").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids")
    )


def write_months(bitmaps: DataFrame, path: str) -> None:
    """Write the months of ``bitmaps`` anew; the rest of the stored months stay."""
    (
        bitmaps.select("measure", "piece", "ids", "month")
        .hint("rebalance", "month")
        .write.partitionBy("month")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def stored_months(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(path)


def distinct_counts(bitmaps: DataFrame, first: date | None = None, until: date | None = None, by: Column | None = None) -> DataFrame:
    """Distinct ids of each measure over the months from ``first`` up to, not including, ``until``.

    ``by`` tells periods apart, for example ``trunc(month, 'quarter')``; it goes into a column ``period``.
    """
    if first is not None:
        bitmaps = bitmaps.filter(F.col("month") >= F.lit(first))
    if until is not None:
        bitmaps = bitmaps.filter(F.col("month") < F.lit(until))
    period = [] if by is None else [by.alias("period")]
    whole = bitmaps.groupBy(*period, "measure", "piece").agg(F.bitmap_or_agg("ids").alias("ids"))
    return whole.groupBy(*[c for c in ("period",) if period], "measure").agg(F.sum(F.bitmap_count("ids")).alias("distinct_ids"))

"""Org chart, category tree, calendar and movement chains."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import day_of_week
from stockyard.operators.chains import chain_rows, repeat_rows
from stockyard.operators.hierarchy import rooted
from stockyard.session import materialize

MOVEMENT = (
    "movement_id",
    "product_id",
    "warehouse_id",
    "movement_type",
    "quantity",
    "movement_date",
)


def org_chart(ds: Dataset) -> DataFrame:
    staff = ds.employees.select(
        "employee_id", "manager_id", F.concat("first_name", F.lit(" "), "last_name").alias("name")
    )
    chart = rooted(staff, "employee_id", "manager_id")
    return chart.select("employee_id", "manager_id", "name", "depth").orderBy("depth", "name", "employee_id")


def category_tree(ds: Dataset) -> DataFrame:
    tree = rooted(ds.product_categories, "category_id", "parent_category_id", label="name")
    return tree.select("category_id", "name", "parent_category_id", "full_path", "depth").orderBy(
        "full_path", "category_id"
    )


def date_dimension(
    spark: SparkSession,
    start: date = date(2023, 1, 1),
    end: date = date(2026, 12, 31),
    limit: int | None = 30,
) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return _calendar(bounds, limit)


def calendar_of_orders(ds: Dataset, limit: int | None = None) -> DataFrame:
    """The date dimension that spans the orders at hand."""
    bounds = ds.sales_orders.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    return _calendar(bounds, limit)


def _calendar(bounds: DataFrame, limit: int | None) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    weekday = day_of_week("date")
    dimension = days.select(
        "date",
        weekday.alias("day_of_week"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
    return dimension if limit is None else dimension.orderBy("date").limit(limit)


def _is_inbound() -> Column:
    return F.col("movement_type") == "inbound"


def movement_chain_steps(ds: Dataset, steps: int = 5) -> DataFrame:
    """Each movement with every step it takes in a chain and how many chains bring it there."""
    moves = ds.inventory_movements.select(*MOVEMENT)
    return chain_rows(moves, ["product_id", "warehouse_id"], "movement_date", _is_inbound(), steps)


def movement_chain(ds: Dataset, limit: int | None = 100, steps: int = 5) -> DataFrame:
    """From each receipt, every strictly later movement of the same stock, up to ``steps`` deep.

    A movement appears once for each chain that reaches it. Sorted by product, warehouse and date;
    with a limit only keys up to the ``limit``-th receipt in that order can appear, because each
    receipt is itself a row of the result. That bound is exact and prunes the rest up front.
    """
    moves = ds.inventory_movements.select(*MOVEMENT)
    key = ["product_id", "warehouse_id", "movement_date"]
    order = [*key, "movement_id", "step"]
    if limit is None:
        rows = chain_rows(moves, key[:2], key[2], _is_inbound(), steps)
        return repeat_rows(rows, "occurrences").select(*MOVEMENT, "step").orderBy(*order)
    first = moves.filter(_is_inbound()).select(*key).orderBy(*key).limit(limit)
    bound = first.agg(F.when(F.count("*") == limit, F.max(F.struct(*key)))).scalar()
    near = materialize(moves.filter(bound.isNull() | (F.struct(*key) <= bound)))
    rows = chain_rows(near, key[:2], key[2], _is_inbound(), steps)
    head = rows.orderBy(*order).limit(limit)
    capped = head.withColumn("occurrences", F.least("occurrences", F.lit(limit)))
    return repeat_rows(capped, "occurrences").select(*MOVEMENT, "step").orderBy(*order).limit(limit)

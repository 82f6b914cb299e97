"""The three timed queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before
from stockyard.functions.ordering import ascending, descending, top
from stockyard.plans import views


def dead_stock(ds: Dataset) -> DataFrame:
    return views.dead_stock(ds).select("name", "warehouse_id", "quantity_on_hand")


def warehouse_movements_30d(ds: Dataset, warehouse_id: int = 3) -> DataFrame:
    """Movements of one warehouse in 30 days; no row, rather than 0, if there were none."""
    return (
        ds.movements_since(before(ds.as_of, "30 DAYS"))
        .filter(F.col("warehouse_id") == warehouse_id)
        .groupBy("warehouse_id")
        .agg(F.count("*").alias("movements"))
    )


def customer_ltv(ds: Dataset, limit: int | None = 20) -> DataFrame:
    return top(
        views.customer_ltv(ds).select("customer_id", "name", "lifetime_value"),
        limit,
        descending("lifetime_value"),
        ascending("customer_id"),
    )

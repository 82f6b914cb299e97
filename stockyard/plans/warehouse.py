"""Warehouse analysis: utilization, transfers, staff output and revenue share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.money import percent_of
from stockyard.functions.ordering import ascending, descending, top
from stockyard.plans import views


def warehouse_utilization(ds: Dataset) -> DataFrame:
    """Only warehouses that hold inventory rows."""
    return (
        ds.warehouses.select("warehouse_id", "name", "capacity_units")
        .join(views.stored_units(ds), "warehouse_id")
        .select(
            "name",
            "capacity_units",
            "units_stored",
            percent_of(F.col("units_stored"), F.col("capacity_units"), 1).alias("utilization_pct"),
        )
        .orderBy(descending("utilization_pct"), ascending("name"))
    )


def transfer_volume(ds: Dataset) -> DataFrame:
    lanes = (
        ds.stock_transfers.filter(F.col("status") == "completed")
        .groupBy("from_warehouse_id", "to_warehouse_id")
        .agg(F.count("*").alias("transfers"), F.sum("quantity").alias("units"))
    )
    source = ds.warehouses.select(
        F.col("warehouse_id").alias("from_warehouse_id"), F.col("name").alias("from_warehouse")
    )
    target = ds.warehouses.select(F.col("warehouse_id").alias("to_warehouse_id"), F.col("name").alias("to_warehouse"))
    return (
        lanes.join(source, "from_warehouse_id")
        .join(target, "to_warehouse_id")
        .groupBy("from_warehouse", "to_warehouse")
        .agg(F.sum("transfers").alias("transfer_count"), F.sum("units").alias("units_transferred"))
        .orderBy(descending("units_transferred"), ascending("from_warehouse"), ascending("to_warehouse"))
    )


def employee_orders(ds: Dataset, limit: int | None = 20) -> DataFrame:
    """Active orders by employee name and by the order's warehouse; same-named staff add up."""
    handled = views.active(ds.sales_orders).groupBy("employee_id", "warehouse_id").agg(F.count("*").alias("orders"))
    staff = ds.employees.select("employee_id", F.concat("first_name", F.lit(" "), "last_name").alias("employee"))
    places = ds.warehouses.select("warehouse_id", F.col("name").alias("warehouse"))
    named = (
        handled.join(staff, "employee_id")
        .join(places, "warehouse_id")
        .groupBy("employee", "warehouse")
        .agg(F.sum("orders").alias("orders_handled"))
    )
    return top(named, limit, descending("orders_handled"), ascending("employee"), ascending("warehouse"))


def warehouse_revenue_share(ds: Dataset) -> DataFrame:
    per_warehouse = (
        views.active(views.order_revenue(ds)).groupBy("warehouse_id").agg(F.sum("order_total").alias("revenue"))
    )
    named = (
        ds.warehouses.select("warehouse_id", "name")
        .join(per_warehouse, "warehouse_id")
        .groupBy("name")
        .agg(F.sum("revenue").alias("revenue"))
    )
    total = named.agg(F.sum("revenue")).scalar()
    return named.select("name", "revenue", percent_of(F.col("revenue"), total, 2).alias("pct_of_total")).orderBy(
        descending("revenue"), ascending("name")
    )

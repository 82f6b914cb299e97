"""Inventory analysis: levels, dead stock, velocity, aging, reorder and stockout risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before, day
from stockyard.functions.money import quotient
from stockyard.functions.ordering import ascending, descending, some, top
from stockyard.operators.ledger import outbound_since
from stockyard.plans import views


def _by_warehouse_name(ds: Dataset, per_id: DataFrame, measure: str, name: str) -> DataFrame:
    return (
        ds.warehouses.select("warehouse_id", F.col("name").alias(name))
        .join(per_id, "warehouse_id")
        .groupBy(name)
        .agg(F.sum(measure).alias(measure))
        .orderBy(descending(measure), ascending(name))
    )


def stock_by_warehouse(ds: Dataset) -> DataFrame:
    units = views.stored_units(ds).withColumnRenamed("units_stored", "total_units")
    return _by_warehouse_name(ds, units, "total_units", "warehouse")


def dead_stock(ds: Dataset, limit: int | None = 50) -> DataFrame:
    chosen = some(views.dead_stock(ds), limit, ascending("product_id"), ascending("warehouse_id"))
    return chosen.select("name", "warehouse_id", "quantity_on_hand")


def _units_moved(ds: Dataset, interval: str) -> DataFrame:
    """Outbound units per product since the bound; later rows have no upper bound."""
    return (
        outbound_since(ds, before(ds.as_of, interval))
        .groupBy("product_id")
        .agg(F.sum(-F.col("quantity")).alias("units"))
    )


def fast_movers(ds: Dataset, limit: int | None = 20) -> DataFrame:
    named = (
        _units_moved(ds, "30 DAYS")
        .join(ds.products.select("product_id", "name"), "product_id")
        .groupBy("name")
        .agg(F.sum("units").alias("units_moved"))
    )
    return top(named, limit, descending("units_moved"), ascending("name"))


def slow_movers(ds: Dataset, limit: int | None = 20) -> DataFrame:
    """Products that did not move at all come first."""
    named = (
        ds.products.select("product_id", "name")
        .join(_units_moved(ds, "90 DAYS"), "product_id", "left")
        .groupBy("name")
        .agg(F.coalesce(F.sum("units"), F.lit(0).cast("bigint")).alias("units_moved"))
    )
    return top(named, limit, ascending("units_moved"), ascending("name"))


def inventory_aging(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Days since the last receipt; never received sorts first, a later receipt is negative."""
    last = (
        ds.inventory_movements.filter(F.col("movement_type") == "inbound")
        .groupBy("product_id", "warehouse_id")
        .agg(F.max("movement_date").alias("received_at"))
    )
    aged = ds.inventory.join(last, ["product_id", "warehouse_id"], "left").select(
        "product_id",
        "warehouse_id",
        "quantity_on_hand",
        F.datediff(day(ds.as_of), F.col("received_at").cast("date")).alias("days_since_last_inbound"),
    )
    return top(
        aged, limit, descending("days_since_last_inbound"), ascending("product_id"), ascending("warehouse_id")
    )


def below_reorder(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Compares what is on hand, not what is available."""
    low = ds.inventory.join(ds.products.select("product_id", "name", "reorder_level"), "product_id").filter(
        F.col("quantity_on_hand") < F.col("reorder_level")
    )
    chosen = some(low, limit, ascending("product_id"), ascending("warehouse_id"))
    return chosen.select("name", "warehouse_id", "quantity_on_hand", "reorder_level")


def inventory_value(ds: Dataset) -> DataFrame:
    return _by_warehouse_name(ds, views.stock_value(ds), "inventory_value", "name")


def stockout_risk(ds: Dataset, limit: int | None = 50, days: int = 7) -> DataFrame:
    """Less than ``days`` days of cover at the 30-day velocity.

    The threshold compares whole numbers (``on_hand * 30 < days * units``), so no rounded ratio
    decides which rows appear.
    """
    velocity = (
        outbound_since(ds, before(ds.as_of, "30 DAYS"))
        .groupBy("product_id", "warehouse_id")
        .agg(F.sum(-F.col("quantity")).alias("units"))
        .filter("units != 0")
    )
    on_hand, units = F.col("quantity_on_hand").cast("bigint"), F.col("units")
    short = F.when(units > 0, on_hand * 30 < units * days).otherwise(on_hand * 30 > units * days)
    risky = (
        ds.inventory.join(velocity, ["product_id", "warehouse_id"])
        .filter(short)
        .select(
            "product_id",
            "warehouse_id",
            "quantity_on_hand",
            (units.cast("double") / F.lit(30.0)).alias("daily_avg_out"),
            quotient(on_hand * 30, units, 1).alias("days_of_cover"),
        )
    )
    return top(risky, limit, ascending("days_of_cover"), ascending("product_id"), ascending("warehouse_id"))

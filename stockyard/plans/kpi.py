"""Key figures: snapshot, margin, fulfilment and turnover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before, lead_days
from stockyard.functions.money import quotient, sum_net
from stockyard.functions.ordering import ascending, descending, top
from stockyard.plans.views import active, received


def kpi_snapshot(ds: Dataset) -> DataFrame:
    """One row. A sum over nothing is NULL, a count over nothing is 0."""
    orders, lines = ds.sales_since(before(ds.as_of, "30 DAYS"))
    recent = active(orders).select("so_id")
    per_order = lines.groupBy("so_id").agg(sum_net().alias("total"))
    sold = per_order.join(recent, "so_id").agg(F.sum("total").alias("revenue_30d"))
    count = recent.agg(F.count("*"))
    costs = ds.products.select("product_id", "unit_cost", "reorder_level")
    stock = ds.inventory.join(costs, "product_id").agg(
        F.sum(F.col("quantity_on_hand") * F.col("unit_cost")).alias("value"),
        F.count_if(F.col("quantity_on_hand") < F.col("reorder_level")).alias("low"),
    )
    lead = received(ds.purchase_orders).agg(quotient(F.sum(lead_days()), F.nullif(F.count(lead_days()), F.lit(0)), 1))
    return sold.select(
        "revenue_30d",
        count.scalar().alias("orders_30d"),
        stock.select("value").scalar().alias("total_inventory_value"),
        stock.select("low").scalar().alias("products_below_reorder"),
        lead.scalar().alias("avg_supplier_lead_time"),
    )


def gross_margin(ds: Dataset, limit: int | None = 20) -> DataFrame:
    """A price of zero is an error, as in SQL."""
    price, cost = F.col("unit_price"), F.col("unit_cost")
    priced = ds.products.select(
        "product_id", "name", "unit_price", "unit_cost", quotient(price - cost, price, 1, 100).alias("gross_margin_pct")
    )
    return top(priced, limit, descending("gross_margin_pct"), ascending("name"), ascending("product_id")).drop(
        "product_id"
    )


def fulfillment_rate(ds: Dataset) -> DataFrame:
    """Delivered share of active orders; no active order is a division by zero."""
    delivered = F.count_if(F.col("status") == "delivered")
    live = F.count_if(F.col("status") != "cancelled")
    return ds.sales_orders.agg(quotient(delivered, live, 2, 100).alias("fulfillment_rate_pct"))


def inventory_turnover(ds: Dataset) -> DataFrame:
    """A year's cost of goods over the mean value of an inventory row."""
    costs = ds.products.select("product_id", "unit_cost")
    orders, lines = ds.sales_since(before(ds.as_of, "1 YEAR"))
    # Summed per order and product first: a huge order is one partial sum per task before it meets its header.
    units = lines.groupBy("so_id", "product_id").agg(F.sum("quantity").alias("quantity"))
    sold = (
        units.join(active(orders).select("so_id"), "so_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"))
        .join(costs, "product_id")
        .agg(F.sum(F.col("units") * F.col("unit_cost")).alias("cost"))
    )
    stock = ds.inventory.join(costs, "product_id").agg(
        F.sum(F.col("quantity_on_hand") * F.col("unit_cost")).alias("value"), F.count("*").alias("rows")
    )
    value, rows = stock.select("value").scalar(), stock.select("rows").scalar()
    by_value = sold.select("cost", F.nullif(value, F.lit(0)).alias("value"), rows.alias("rows"))
    ratio = quotient(F.col("cost").cast("decimal(24,2)") * F.col("rows"), F.col("value"), 2)
    return by_value.select(ratio.alias("inventory_turnover_ratio"))

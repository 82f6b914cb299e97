"""The ten live views, as functions of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before, lead_days
from stockyard.functions.money import percent_of, quotient, sum_gross, sum_net
from stockyard.operators.ledger import outbound_since


def active(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") != "cancelled")


def received(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == "received")


def order_totals(ds: Dataset, *, discounted: bool = True) -> DataFrame:
    """Line totals per order. Summed before any join, so one huge order is one partial sum per task."""
    total = sum_net() if discounted else sum_gross()
    return ds.sales_order_items.groupBy("so_id").agg(total.alias("order_total"))


def order_revenue(ds: Dataset) -> DataFrame:
    """One row for each order that has a line, whatever its status."""
    headers = ds.sales_orders.select("so_id", "customer_id", "warehouse_id", "employee_id", "order_date", "status")
    return headers.join(order_totals(ds), "so_id")


def customer_ltv(ds: Dataset) -> DataFrame:
    spent = (
        active(order_revenue(ds))
        .groupBy("customer_id")
        .agg(F.sum("order_total").alias("lifetime_value"), F.count("so_id").alias("order_count"))
    )
    return ds.customers.select("customer_id", "name", "segment").join(spent, "customer_id")


def daily_revenue(ds: Dataset) -> DataFrame:
    return active(order_revenue(ds)).groupBy("order_date").agg(F.sum("order_total").alias("revenue"))


def inventory_status(ds: Dataset) -> DataFrame:
    products = ds.products.select("product_id", F.col("name").alias("product_name"), "reorder_level")
    warehouses = ds.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"))
    return (
        ds.inventory.join(products, "product_id")
        .join(warehouses, "warehouse_id")
        .select(
            "product_id",
            "product_name",
            "warehouse_id",
            "warehouse_name",
            "quantity_on_hand",
            "quantity_reserved",
            (F.col("quantity_on_hand") - F.col("quantity_reserved")).alias("quantity_available"),
            "reorder_level",
            (F.col("quantity_on_hand") < F.col("reorder_level")).alias("needs_reorder"),
        )
    )


def dead_stock(ds: Dataset) -> DataFrame:
    """Stock on hand without an outbound movement in the last 90 days."""
    # One row per stocked pair on the right as well, so a busy pair cannot swell a task.
    moving = outbound_since(ds, before(ds.as_of, "90 DAYS")).select("product_id", "warehouse_id").distinct()
    return (
        ds.inventory.filter("quantity_on_hand > 0")
        .join(moving, ["product_id", "warehouse_id"], "left_anti")
        .join(ds.products.select("product_id", "name"), "product_id")
        .select("product_id", "name", "warehouse_id", "quantity_on_hand")
    )


def stock_value(ds: Dataset) -> DataFrame:
    """Value at cost per warehouse id."""
    costs = ds.products.select("product_id", "unit_cost")
    return (
        ds.inventory.join(costs, "product_id")
        .groupBy("warehouse_id")
        .agg(F.sum(F.col("quantity_on_hand") * F.col("unit_cost")).alias("inventory_value"))
    )


def inventory_value_by_warehouse(ds: Dataset) -> DataFrame:
    return ds.warehouses.select("warehouse_id", "name").join(stock_value(ds), "warehouse_id")


def stored_units(ds: Dataset) -> DataFrame:
    return ds.inventory.groupBy("warehouse_id").agg(F.sum("quantity_on_hand").alias("units_stored"))


def warehouse_utilization(ds: Dataset) -> DataFrame:
    """Every warehouse; an empty one counts as 0."""
    units = F.coalesce(F.col("units_stored"), F.lit(0).cast("bigint"))
    return (
        ds.warehouses.select("warehouse_id", "name", "capacity_units")
        .join(stored_units(ds), "warehouse_id", "left")
        .withColumn("units_stored", units)
        .withColumn("utilization_pct", percent_of(F.col("units_stored"), F.col("capacity_units"), 1))
    )


def employee_productivity(ds: Dataset) -> DataFrame:
    """Active orders per employee, at the employee's home warehouse; 0 is kept."""
    handled = active(ds.sales_orders).groupBy("employee_id").agg(F.count("so_id").alias("orders_handled"))
    return ds.employees.join(handled, "employee_id", "left").select(
        "employee_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("employee_name"),
        "warehouse_id",
        F.coalesce("orders_handled", F.lit(0).cast("bigint")).alias("orders_handled"),
    )


def supplier_performance(ds: Dataset) -> DataFrame:
    """Deliveries without an actual date count as not on time."""
    on_time = F.count_if(F.col("actual_delivery_date") <= F.col("expected_delivery_date"))
    delivered = (
        received(ds.purchase_orders)
        .groupBy("supplier_id")
        .agg(
            quotient(F.sum(lead_days()), F.nullif(F.count(lead_days()), F.lit(0)), 1).alias("avg_lead_time_days"),
            percent_of(on_time, F.count("*"), 1).alias("on_time_pct"),
        )
    )
    return ds.suppliers.select("supplier_id", "name", "rating").join(delivered, "supplier_id")


def spend_by_supplier(ds: Dataset) -> DataFrame:
    """Received quantity times cost, summed per order before the header is joined."""
    per_order = ds.purchase_order_items.groupBy("po_id").agg(
        F.sum(F.col("quantity_received") * F.col("unit_cost")).alias("spend")
    )
    headers = received(ds.purchase_orders).select("po_id", "supplier_id")
    return headers.join(per_order, "po_id").groupBy("supplier_id").agg(F.sum("spend").alias("total_spend"))


def supplier_spend(ds: Dataset) -> DataFrame:
    return ds.suppliers.select("supplier_id", "name").join(spend_by_supplier(ds), "supplier_id")


VIEWS = {
    "v_inventory_status": inventory_status,
    "v_dead_stock": dead_stock,
    "v_inventory_value_by_warehouse": inventory_value_by_warehouse,
    "v_order_revenue": order_revenue,
    "v_customer_ltv": customer_ltv,
    "v_daily_revenue": daily_revenue,
    "v_warehouse_utilization": warehouse_utilization,
    "v_employee_productivity": employee_productivity,
    "v_supplier_performance": supplier_performance,
    "v_supplier_spend": supplier_spend,
}


def register_views(ds: Dataset) -> None:
    """Make the tables and the views available to ``spark.sql``."""
    ds.register_views()
    for name, build in VIEWS.items():
        build(ds).createOrReplaceTempView(name)

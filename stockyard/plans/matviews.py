"""The five stored summaries: definitions, full refresh and incremental refresh."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before, instant, month_of
from stockyard.functions.money import quotient, sum_net
from stockyard.plans import views
from stockyard.sources.store import SnapshotStore


def monthly_sales(ds: Dataset) -> DataFrame:
    return (
        views.active(views.order_revenue(ds))
        .groupBy(month_of("order_date").alias("month"))
        .agg(F.sum("order_total").alias("revenue"), F.count("*").alias("order_count"))
    )


def inventory_snapshot(ds: Dataset) -> DataFrame:
    return views.inventory_status(ds).select(
        "product_id", "warehouse_id", "quantity_on_hand", "quantity_available", "needs_reorder"
    )


def supplier_metrics(ds: Dataset) -> DataFrame:
    spend = views.spend_by_supplier(ds)
    return views.supplier_performance(ds).join(spend, "supplier_id")


def dashboard_kpis(ds: Dataset, snapshot: DataFrame | None = None) -> DataFrame:
    """One row. Counts reorders in the stored inventory snapshot, so that one is published first.

    The lead time is the mean of the rounded means per supplier, unlike the KPI query's overall mean.
    """
    snapshot = inventory_snapshot(ds) if snapshot is None else snapshot
    orders, lines = ds.sales_since(before(ds.as_of, "30 DAYS"))
    totals = lines.groupBy("so_id").agg(sum_net().alias("total"))
    recent = totals.join(views.active(orders).select("so_id"), "so_id")
    revenue = recent.agg(F.sum("total").alias("revenue_30d"))
    value = views.inventory_value_by_warehouse(ds).agg(F.sum("inventory_value"))
    low = snapshot.agg(F.count_if("needs_reorder"))
    timed = F.count("avg_lead_time_days")
    lead = views.supplier_performance(ds).agg(quotient(F.sum("avg_lead_time_days"), F.nullif(timed, F.lit(0)), 1))
    return revenue.select(
        "revenue_30d",
        value.scalar().alias("total_inventory_value"),
        low.scalar().alias("products_below_reorder"),
        lead.scalar().alias("avg_supplier_lead_time"),
        instant(ds.as_of).alias("refreshed_at"),
    )


def warehouse_summary(ds: Dataset) -> DataFrame:
    """Only warehouses with stock and staff; orders count at the employee's home warehouse."""
    staffed = (
        views.employee_productivity(ds).groupBy("warehouse_id").agg(F.sum("orders_handled").alias("total_orders"))
    )
    return (
        views.warehouse_utilization(ds)
        .select("warehouse_id", "name", "utilization_pct")
        .join(views.stock_value(ds), "warehouse_id")
        .join(staffed, "warehouse_id")
    )


@dataclass(frozen=True)
class Summary:
    build: Callable[[Dataset], DataFrame]
    key: tuple[str, ...] = ()


SUMMARIES: dict[str, Summary] = {
    "mv_monthly_sales": Summary(monthly_sales, ("month",)),
    "mv_inventory_snapshot": Summary(inventory_snapshot, ("product_id", "warehouse_id")),
    "mv_supplier_metrics": Summary(supplier_metrics, ("supplier_id",)),
    "mv_dashboard_kpis": Summary(dashboard_kpis),
    "mv_warehouse_summary": Summary(warehouse_summary, ("warehouse_id",)),
}


def refresh(ds: Dataset, store: SnapshotStore, name: str) -> int:
    """Rebuild one summary; readers keep the old copy until the new one is complete and unique."""
    summary = SUMMARIES[name]
    if name == "mv_dashboard_kpis":
        df = dashboard_kpis(ds, store.read("mv_inventory_snapshot"))
    else:
        df = summary.build(ds)
    return _publish(store, name, df, ds)


def refresh_all(ds: Dataset, store: SnapshotStore) -> list[str]:
    """All summaries in their fixed order; returns their names."""
    for name in SUMMARIES:
        refresh(ds, store, name)
    return list(SUMMARIES)


def _publish(
    store: SnapshotStore, name: str, df: DataFrame, ds: Dataset, meta: dict | None = None, current: dict | None = None
) -> int:
    staged = store.stage({name: df}, current)
    key = SUMMARIES[name].key
    if key:
        written = store.open(staged[name])
        repeated = written.groupBy(*key).count().filter("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"{name}: key {tuple(repeated[0])[:-1]} occurs more than once")
    return store.publish(staged, {f"refreshed_{name}": ds.as_of.isoformat(sep=" "), **(meta or {})})


def add_new_sales(store: SnapshotStore, new_sales: Dataset, batch: int) -> int | None:
    """Fold orders that were not there before (headers with their lines) into the month totals.

    Sums are additive, so this equals a full refresh while stored orders do not change. Batches are numbered upwards; one that
    is already in changes nothing.
    """
    name, mark = "mv_monthly_sales", "sales_added"

    def once(current: dict) -> int | None:
        if current["meta"].get(mark, -1) >= batch:
            return None
        merged = (
            store.open(current["tables"][name])
            .unionByName(monthly_sales(new_sales))
            .groupBy("month")
            .agg(F.sum("revenue").cast("decimal(38,6)").alias("revenue"), F.sum("order_count").alias("order_count"))
        )
        return _publish(store, name, merged, new_sales, {mark: batch}, current)

    return store.retried(once)


def patch_inventory(ds: Dataset, store: SnapshotStore, changed: DataFrame) -> int:
    """Replace the snapshot rows of the (product_id, warehouse_id) pairs in ``changed``."""
    name, key = "mv_inventory_snapshot", ["product_id", "warehouse_id"]
    pairs = changed.select(*key).distinct()
    rows = ds.replace(inventory=ds.inventory.join(pairs, key, "left_semi"))
    kept = store.read(name).join(pairs, key, "left_anti")
    return _publish(store, name, kept.unionByName(inventory_snapshot(rows)), ds)


def patch_suppliers(ds: Dataset, store: SnapshotStore, changed: DataFrame) -> int:
    """Recompute the metrics of the suppliers in ``changed`` (supplier_id)."""
    name = "mv_supplier_metrics"
    ids = changed.select("supplier_id").distinct()
    orders = ds.purchase_orders.join(ids, "supplier_id", "left_semi")
    lines = ds.purchase_order_items.join(orders.select("po_id"), "po_id", "left_semi")
    fresh = supplier_metrics(ds.replace(purchase_orders=orders, purchase_order_items=lines))
    kept = store.read(name).join(ids, "supplier_id", "left_anti")
    return _publish(store, name, kept.unionByName(fresh), ds)


def patch_warehouses(ds: Dataset, store: SnapshotStore, changed: DataFrame) -> int:
    """Recompute the summary rows of the warehouses in ``changed`` (warehouse_id)."""
    name = "mv_warehouse_summary"
    ids = changed.select("warehouse_id").distinct()
    part = ds.replace(
        warehouses=ds.warehouses.join(ids, "warehouse_id", "left_semi"),
        inventory=ds.inventory.join(ids, "warehouse_id", "left_semi"),
        employees=ds.employees.join(ids, "warehouse_id", "left_semi"),
    )
    kept = store.read(name).join(ids, "warehouse_id", "left_anti")
    return _publish(store, name, kept.unionByName(warehouse_summary(part)), ds)

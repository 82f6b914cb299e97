"""Queries behind the dashboard and API endpoints, as functions that return DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.ordering import ascending, descending, top
from stockyard.plans import matviews, sales, views
from stockyard.sources.csv import as_dictionaries
from stockyard.sources.store import SnapshotStore


def dashboard_kpis(store: SnapshotStore) -> DataFrame:
    return store.read("mv_dashboard_kpis")


def current_inventory(ds: Dataset, product_id: int | None = None, warehouse_id: int | None = None) -> DataFrame:
    rows = views.inventory_status(ds)
    if product_id is not None:
        rows = rows.filter(F.col("product_id") == product_id)
    if warehouse_id is not None:
        rows = rows.filter(F.col("warehouse_id") == warehouse_id)
    return rows


def below_reorder(ds: Dataset) -> DataFrame:
    return views.inventory_status(ds).filter("needs_reorder")


def top_selling(ds: Dataset, limit: int = 20) -> DataFrame:
    return sales.best_sellers(ds, limit)


def warehouse_utilization(ds: Dataset) -> DataFrame:
    return top(views.warehouse_utilization(ds), None, descending("utilization_pct"), ascending("warehouse_id"))


def supplier_performance(store: SnapshotStore) -> DataFrame:
    return store.read("mv_supplier_metrics")


def refresh_summaries(ds: Dataset, store: SnapshotStore) -> list[str]:
    return matviews.refresh_all(ds, store)


def respond(path: str, ds: Dataset, store: SnapshotStore, **parameters) -> DataFrame:
    """Rows of a GET endpoint as JSON texts."""
    handlers: dict[str, Callable[[], DataFrame]] = {
        "/dashboard/kpis": lambda: dashboard_kpis(store),
        "/inventory/current": lambda: current_inventory(ds, **parameters),
        "/inventory/below-reorder": lambda: below_reorder(ds),
        "/analytics/products/top-selling": lambda: top_selling(ds, **parameters),
        "/analytics/warehouses/utilization": lambda: warehouse_utilization(ds),
        "/analytics/suppliers/performance": lambda: supplier_performance(store),
    }
    return as_dictionaries(handlers[path]())

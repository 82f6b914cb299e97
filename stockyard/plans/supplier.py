"""Supplier analysis: lead time, lateness, spend and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import lead_days
from stockyard.functions.money import percent_of, quotient
from stockyard.functions.ordering import ascending, descending, top
from stockyard.operators.positions import rank, with_ranks
from stockyard.plans.views import received, spend_by_supplier


def _deliveries(ds: Dataset) -> DataFrame:
    """Sums per supplier id, so the supplier join sees one row for each."""
    late = F.count_if(F.col("actual_delivery_date") > F.col("expected_delivery_date"))
    return (
        received(ds.purchase_orders)
        .groupBy("supplier_id")
        .agg(
            F.sum(lead_days()).alias("days"),
            F.count(lead_days()).alias("dated"),
            late.alias("late"),
            F.count("*").alias("delivered"),
        )
    )


def _named(ds: Dataset, per_supplier: DataFrame) -> DataFrame:
    return ds.suppliers.select("supplier_id", "name").join(per_supplier, "supplier_id").groupBy("name")


def supplier_lead_time(ds: Dataset) -> DataFrame:
    mean = quotient(F.sum("days"), F.nullif(F.sum("dated"), F.lit(0)), 1)
    return (
        _named(ds, _deliveries(ds))
        .agg(mean.alias("avg_lead_time_days"))
        .orderBy(ascending("avg_lead_time_days"), ascending("name"))
    )


def supplier_late_rate(ds: Dataset, min_deliveries: int = 5) -> DataFrame:
    return (
        _named(ds, _deliveries(ds))
        .agg(F.sum("late").alias("late_count"), F.sum("delivered").alias("total_delivered"))
        .filter(F.col("total_delivered") >= min_deliveries)
        .withColumn("late_pct", percent_of(F.col("late_count"), F.col("total_delivered"), 1))
        .orderBy(descending("late_pct"), ascending("name"))
    )


def _spend_by_name(ds: Dataset) -> DataFrame:
    return _named(ds, spend_by_supplier(ds)).agg(F.sum("total_spend").alias("total_spend"))


def supplier_spend_top(ds: Dataset, limit: int | None = 20) -> DataFrame:
    return top(_spend_by_name(ds), limit, descending("total_spend"), ascending("name"))


def supplier_spend_rank(ds: Dataset) -> DataFrame:
    ranked = with_ranks(_spend_by_name(ds), "total_spend", ["name"], descending=True)
    return ranked.select("name", "total_spend", rank().alias("spend_rank"))


def good_rating_slow_suppliers(ds: Dataset, days: int = 14) -> DataFrame:
    """Rated above the average of rated suppliers, yet slow to deliver.

    Both thresholds compare sums with counts, so no quotient is rounded. Suppliers without a
    dated delivery have no lead time and drop out.
    """
    rated = ds.suppliers.agg(F.sum("rating").alias("points"), F.count("rating").alias("raters"))
    points = rated.select("points").scalar()
    raters = rated.select("raters").scalar()
    slow = _deliveries(ds).filter(F.col("days") > F.col("dated") * days).select("supplier_id")
    return (
        ds.suppliers.filter(F.col("rating") * raters > points)
        .join(slow, "supplier_id", "left_semi")
        .select("name", "rating")
    )

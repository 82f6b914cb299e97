"""Customer analysis: lifetime value, segments, churn, frequency and recency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import before, day
from stockyard.functions.money import percent_of
from stockyard.functions.ordering import ascending, descending, some, top
from stockyard.plans import views


def _spend(ds: Dataset) -> DataFrame:
    """Active orders with lines, summed per customer before the customer join."""
    return (
        views.active(views.order_revenue(ds))
        .groupBy("customer_id")
        .agg(
            F.sum("order_total").alias("spent"),
            F.count("*").alias("orders"),
            F.max("order_date").alias("last_order"),
        )
    )


def customer_ltv_top(ds: Dataset, limit: int | None = 20) -> DataFrame:
    """By customer name; the view of the same kind goes by id."""
    named = (
        ds.customers.select("customer_id", "name")
        .join(_spend(ds), "customer_id")
        .groupBy("name")
        .agg(F.sum("spent").alias("lifetime_value"))
    )
    return top(named, limit, descending("lifetime_value"), ascending("name"))


def segment_revenue_share(ds: Dataset) -> DataFrame:
    segments = (
        ds.customers.select("customer_id", "segment")
        .join(_spend(ds), "customer_id")
        .groupBy("segment")
        .agg(F.sum("spent").alias("revenue"))
    )
    total = segments.agg(F.sum("revenue")).scalar()
    return segments.select("segment", "revenue", percent_of(F.col("revenue"), total, 2).alias("pct")).orderBy(
        descending("revenue"), ascending("segment")
    )


def churn_risk(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """No order of any status in six months, or never."""
    recent = (
        ds.sales_orders.filter(F.col("order_date").cast("timestamp_ntz") > before(ds.as_of, "6 MONTHS"))
        .select("customer_id")
        .distinct()
    )
    quiet = ds.customers.select("customer_id", "name").join(recent, "customer_id", "left_anti")
    return some(quiet, limit, ascending("customer_id"))


def order_frequency(ds: Dataset) -> DataFrame:
    """Customers per number of orders; ``10+`` begins at eleven."""
    placed = ds.sales_orders.groupBy("customer_id").agg(F.count("so_id").alias("orders"))
    orders = F.coalesce(F.col("orders"), F.lit(0))
    bucket = (
        F.when(orders == 0, "0")
        .when(orders.between(1, 3), "1-3")
        .when(orders.between(4, 10), "4-10")
        .otherwise("10+")
    )
    return (
        ds.customers.select("customer_id")
        .join(placed, "customer_id", "left")
        .groupBy(bucket.alias("order_count_bucket"))
        .agg(F.count("*").alias("num_customers"))
        .orderBy("order_count_bucket")
    )


def rfm(ds: Dataset, limit: int | None = 50) -> DataFrame:
    scored = (
        ds.customers.select("customer_id", "name")
        .join(_spend(ds), "customer_id")
        .select(
            "customer_id",
            "name",
            F.datediff(day(ds.as_of), "last_order").alias("recency_days"),
            F.col("orders").alias("frequency"),
            F.col("spent").alias("monetary"),
        )
    )
    return some(scored, limit, ascending("customer_id"))

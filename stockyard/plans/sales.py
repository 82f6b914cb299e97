"""Sales analysis: revenue over time, by category and by segment; best sellers; discounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.dates import month_of, year_of
from stockyard.functions.money import percent_of, quotient, sum_discount, sum_net
from stockyard.functions.ordering import ascending, descending, top
from stockyard.plans.views import active, order_revenue, order_totals


def monthly_revenue(ds: Dataset) -> DataFrame:
    """Unsorted month totals: one row per calendar month, the input of the window plans below."""
    return (
        active(order_revenue(ds))
        .groupBy(month_of("order_date").alias("month"))
        .agg(F.sum("order_total").alias("revenue"))
    )


def revenue_by_month(ds: Dataset) -> DataFrame:
    return monthly_revenue(ds).orderBy("month")


def _growth(ds: Dataset, rows_back: int, name: str) -> DataFrame:
    """Growth against the row ``rows_back`` before: rows, not calendar months, so gaps shift it."""
    earlier = F.lag("revenue", rows_back).over(W.orderBy("month"))
    return (
        monthly_revenue(ds)
        .withColumn("_earlier", earlier)
        .select("month", "revenue", percent_of(F.col("revenue") - F.col("_earlier"), F.col("_earlier"), 2).alias(name))
        .orderBy("month")
    )


def revenue_mom_growth(ds: Dataset) -> DataFrame:
    return _growth(ds, 1, "mom_growth_pct")


def revenue_yoy_growth(ds: Dataset) -> DataFrame:
    return _growth(ds, 12, "yoy_growth_pct")


def revenue_ytd(ds: Dataset) -> DataFrame:
    to_date = W.partitionBy(year_of("month")).orderBy("month")
    return (
        monthly_revenue(ds)
        .withColumn("ytd_running_total", F.sum("revenue").over(to_date))
        .orderBy("month")
    )


def sold_lines(ds: Dataset) -> DataFrame:
    """Lines of active orders, without the header's other columns."""
    return ds.sales_order_items.join(active(ds.sales_orders).select("so_id"), "so_id")


def revenue_by_category(ds: Dataset) -> DataFrame:
    """By category name; children are not added to their parent."""
    per_product = sold_lines(ds).groupBy("product_id").agg(sum_net().alias("revenue"))
    per_category = (
        per_product.join(ds.products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_category.join(ds.product_categories, "category_id")
        .groupBy(F.col("name").alias("category"))
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(descending("revenue"), ascending("category"))
    )


def aov_by_segment(ds: Dataset) -> DataFrame:
    """Average order value; customers without a segment form a group."""
    per_customer = (
        active(order_revenue(ds))
        .groupBy("customer_id")
        .agg(F.sum("order_total").alias("value"), F.count("*").alias("orders"))
    )
    return (
        per_customer.join(ds.customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(quotient(F.sum("value"), F.sum("orders"), 2).alias("avg_order_value"))
        .orderBy(descending("avg_order_value"), ascending("segment"))
    )


def best_sellers(ds: Dataset, limit: int | None = 20) -> DataFrame:
    """By product name, so products that share one are added up."""
    per_product = sold_lines(ds).groupBy("product_id").agg(F.sum("quantity").alias("units"))
    named = (
        per_product.join(ds.products.select("product_id", "name"), "product_id")
        .groupBy("name")
        .agg(F.sum("units").alias("units_sold"))
    )
    return top(named, limit, descending("units_sold"), ascending("name"))


def discount_impact(ds: Dataset) -> DataFrame:
    given = ds.sales_order_items.groupBy("so_id").agg(sum_discount().alias("value"))
    return (
        active(ds.sales_orders)
        .select("so_id", "order_date")
        .join(given, "so_id")
        .groupBy(month_of("order_date").alias("month"))
        .agg(F.sum("value").alias("discount_value"))
        .orderBy("month")
    )


__all__ = [
    "aov_by_segment",
    "best_sellers",
    "discount_impact",
    "monthly_revenue",
    "order_totals",
    "revenue_by_category",
    "revenue_by_month",
    "revenue_mom_growth",
    "revenue_yoy_growth",
    "revenue_ytd",
    "sold_lines",
]

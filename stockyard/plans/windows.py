"""Latest rows, quartiles, gaps, first/last values, moving averages and distributions.

None of these sends a whole key or the whole table through one window task: latest/first/last are
aggregates with map-side combine, gaps work on distinct days, and global ranks use positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.money import quotient, sum_gross
from stockyard.functions.ordering import ascending, some, top
from stockyard.operators.positions import cume_dist, ntile, percent_rank, with_ranks
from stockyard.plans.views import active


def latest_order_per_customer(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """The order with the latest date; of several on that date, the highest order id."""
    orders = ds.sales_orders
    row = F.struct(*orders.columns)
    latest = (
        orders.groupBy(F.col("customer_id").alias("_customer"))
        .agg(F.max_by(row, F.struct("order_date", "so_id")).alias("order"))
        .select("order.*", F.lit(1).cast("bigint").alias("rn"))
    )
    return some(latest, limit, ascending("customer_id"))


def product_revenue(ds: Dataset) -> DataFrame:
    """Before discount, all orders."""
    sold = ds.sales_order_items.groupBy("product_id").agg(sum_gross().alias("revenue"))
    return sold.join(ds.products.select("product_id"), "product_id", "left_semi")


def product_revenue_quartile(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Quartile 1 holds the largest revenues; ties are ordered by product id."""
    ranked = with_ranks(product_revenue(ds), "revenue", ["product_id"], descending=True)
    chosen = ranked if limit is None else ranked.orderBy("position").limit(limit)
    return chosen.select("product_id", "revenue", ntile(4).alias("revenue_quartile"))


def order_gap(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Days since the customer's previous active order (0 for a second one on the same day).

    The lag runs over a customer's distinct order days, which the calendar bounds. The day's first
    order takes the gap and any other takes 0.
    """
    orders = active(ds.sales_orders).select("customer_id", "order_date", "so_id")
    by_time = (ascending("customer_id"), ascending("order_date"), ascending("so_id"))
    if limit is not None:
        orders = orders.orderBy(*by_time).limit(limit)  # the row before a chosen one is chosen too
    days = orders.groupBy("customer_id", "order_date").agg(F.count("*").alias("orders"))
    previous = F.lag("order_date").over(W.partitionBy("customer_id").orderBy("order_date"))
    gaps = days.select("customer_id", "order_date", "orders", F.datediff("order_date", previous).alias("gap"))
    repeats = F.sequence(F.lit(1), F.col("orders").cast("int"))  # the orders of one customer on one day
    return gaps.select("customer_id", "order_date", "gap", F.explode(repeats).alias("nth")).select(
        "customer_id", "order_date", F.when(F.col("nth") == 1, F.col("gap")).otherwise(0).alias("days_since_prev_order")
    )


def first_last_price(ds: Dataset, limit: int | None = 50) -> DataFrame:
    prices = ds.sales_order_items.groupBy("product_id").agg(
        F.min_by("unit_price", "so_item_id").alias("first_price"),
        F.max_by("unit_price", "so_item_id").alias("latest_price"),
    )
    return some(prices, limit, ascending("product_id"))


def rolling_7day_revenue(ds: Dataset, limit: int | None = 60) -> DataFrame:
    """Mean over up to seven days that had sales, before discount; the limit keeps the first days."""
    per_order = ds.sales_order_items.groupBy("so_id").agg(sum_gross().alias("value"))
    days = (
        active(ds.sales_orders)
        .select("so_id", F.col("order_date").alias("day"))
        .join(per_order, "so_id")
        .groupBy("day")
        .agg(F.sum("value").alias("revenue"))
    )
    week = W.orderBy("day").rowsBetween(-6, 0)  # one row per calendar day
    sums = days.select("day", "revenue", F.sum("revenue").over(week).alias("sum"), F.count("revenue").over(week).alias("n"))
    return top(sums.select("day", "revenue", quotient(F.col("sum"), F.col("n"), 2).alias("rolling_7day_avg")), limit, ascending("day"))


def employee_percentile(ds: Dataset) -> DataFrame:
    handled = ds.sales_orders.groupBy("employee_id").agg(F.count("*").alias("orders_handled"))
    ranked = with_ranks(handled, "orders_handled", ["employee_id"])
    return ranked.select("employee_id", "orders_handled", percent_rank(3).alias("percentile"))


def order_value_cume_dist(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Share of orders worth no more than this one; the limit keeps the smallest orders."""
    valued = (
        ds.sales_order_items.groupBy("so_id")
        .agg(sum_gross().alias("order_total"))
        .join(ds.sales_orders.select("so_id"), "so_id", "left_semi")
    )
    ranked = with_ranks(valued, "order_total", ["so_id"])
    chosen = ranked if limit is None else ranked.orderBy("position").limit(limit)
    return chosen.select("so_id", "order_total", cume_dist(3).alias("cume_dist"))

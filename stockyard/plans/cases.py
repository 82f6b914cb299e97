"""Case studies that combine several parts of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.functions.money import ratio
from stockyard.functions.ordering import ascending, descending, some, top
from stockyard.plans.views import stored_units


def popular_understocked(ds: Dataset, limit: int | None = 20, dedupe: bool = False) -> DataFrame:
    """Products with stock corrections, by units sold.

    The defining join pairs every sale with every correction of its product, so units count once
    per correction. Summing both sides per product and multiplying gives the same numbers without
    the pairs; ``dedupe`` counts each unit once.
    """
    sold = ds.sales_order_items.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    corrected = (
        ds.inventory_movements.filter(F.col("movement_type") == "adjustment")
        .groupBy("product_id")
        .agg(F.count("*").alias("corrections"))
    )
    corrections = F.coalesce(F.col("corrections"), F.lit(0).cast("bigint"))
    weight = F.lit(1) if dedupe else F.greatest(corrections, F.lit(1))
    named = (
        ds.products.select("product_id", "name")
        .join(sold, "product_id")
        .join(corrected, "product_id", "left")
        .groupBy("name")
        .agg(
            F.sum(F.col("units") * weight).alias("units_sold"),
            F.sum(corrections).alias("stockout_adjustments"),
        )
        .filter("stockout_adjustments > 0")
    )
    return top(named, limit, descending("units_sold"), ascending("name"))


def full_and_slow_warehouses(ds: Dataset, utilization: int = 90) -> DataFrame:
    """Over ``utilization`` percent full, and fewer orders per employee than the average warehouse."""
    fill = (
        ds.warehouses.select("warehouse_id", "name", "capacity_units")
        .join(stored_units(ds), "warehouse_id")
        .filter(F.col("units_stored") * 100 > F.col("capacity_units").cast("bigint") * utilization)
        .select(
            "warehouse_id",
            "name",
            (F.lit(100.0) * ratio(F.col("units_stored"), F.col("capacity_units"))).alias("utilization_pct"),
        )
    )
    # Counted per (warehouse, employee) first: a busy warehouse arrives as one row per employee.
    output = (
        ds.sales_orders.groupBy("warehouse_id", "employee_id")
        .agg(F.count("*").alias("orders"))
        .groupBy("warehouse_id")
        .agg(ratio(F.sum("orders"), F.count("*")).alias("orders_per_employee"))
    )
    mean = output.agg(F.avg("orders_per_employee")).scalar()
    return (
        fill.join(output.filter(F.col("orders_per_employee") < mean), "warehouse_id")
        .select("name", "utilization_pct", "orders_per_employee")
    )


def supplier_rank_in_country(ds: Dataset) -> DataFrame:
    """Rank by rating inside a country, unrated first; unknown country is a group.

    A rating has at most 51 values, so the rank of a rating comes from counts per (country, rating).
    """
    counted = ds.suppliers.groupBy("country", "rating").agg(F.count("*").alias("tied"))
    better = W.partitionBy("country").orderBy(descending("rating")).rowsBetween(W.unboundedPreceding, -1)
    ranks = counted.select(
        F.col("country").alias("_country"),
        F.col("rating").alias("_rating"),
        (F.coalesce(F.sum("tied").over(better), F.lit(0)) + 1).alias("rank_in_country"),
    )
    same = F.col("country").eqNullSafe(F.col("_country")) & F.col("rating").eqNullSafe(F.col("_rating"))
    return ds.suppliers.join(ranks, same).select("name", "country", "rating", "rank_in_country")


def never_bought_by_wholesale(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Product names of which some product was on no wholesale order, cancelled ones included."""
    wholesale = ds.customers.filter(F.col("segment") == "wholesale").select("customer_id")
    orders = ds.sales_orders.join(wholesale, "customer_id", "left_semi").select("so_id")
    bought = ds.sales_order_items.join(orders, "so_id", "left_semi").select("product_id").distinct()
    names = ds.products.join(bought, "product_id", "left_anti").select("name").distinct()
    return some(names, limit, ascending("name"))


def same_title_pair_counts(ds: Dataset) -> DataFrame:
    """How many pairs of one job title there are for each two warehouses: all pairs, counted from heads per title and place."""
    heads = ds.employees.filter("job_title is not null").groupBy("job_title", "warehouse_id").agg(F.count("*").alias("heads"))
    a = heads.select("job_title", F.col("warehouse_id").alias("warehouse_a"), F.col("heads").alias("heads_a"))
    b = heads.select("job_title", F.col("warehouse_id").alias("warehouse_b"), F.col("heads").alias("heads_b"))
    return (
        a.join(b, "job_title")  # a row for each title and warehouse on either side
        .filter("warehouse_a < warehouse_b")
        .select("job_title", "warehouse_a", "warehouse_b", (F.col("heads_a") * F.col("heads_b")).alias("pairs"))
    )


def same_title_pairs(ds: Dataset, limit: int | None = 50) -> DataFrame:
    """Pairs of employees with one job title in different warehouses, smaller id first.

    With a limit, the first pairs by (first id, second id): only the first ``limit`` employees that
    have a partner can open one of them, and whether somebody has a partner follows from the two
    highest ids per title that lie in different warehouses. No title is paired with itself.
    """
    staff = ds.employees.select(
        "employee_id",
        "warehouse_id",
        "job_title",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
    )
    openers = staff if limit is None else _first_openers(staff, limit)
    a = openers.select(
        F.col("employee_id").alias("a_id"),
        F.col("warehouse_id").alias("a_warehouse"),
        F.col("full_name").alias("employee_a"),
        "job_title",
    )
    b = staff.select(
        F.col("employee_id").alias("b_id"),
        F.col("warehouse_id").alias("b_warehouse"),
        F.col("full_name").alias("employee_b"),
        "job_title",
    )
    pairs = a.join(b, "job_title").filter((F.col("a_warehouse") != F.col("b_warehouse")) & (F.col("a_id") < F.col("b_id")))
    return some(pairs, limit, ascending("a_id"), ascending("b_id")).select("employee_a", "employee_b", "job_title")


def _first_openers(staff: DataFrame, limit: int) -> DataFrame:
    highest = staff.groupBy("job_title", "warehouse_id").agg(F.max("employee_id").alias("top_id"))
    best = highest.groupBy("job_title").agg(F.max(F.struct("top_id", "warehouse_id")).alias("best"))
    second = (
        highest.join(best, "job_title")
        .filter(F.col("warehouse_id") != F.col("best.warehouse_id"))
        .groupBy("job_title")
        .agg(F.max("top_id").alias("other_id"))
    )
    reach = best.join(second, "job_title")
    partner = F.when(F.col("warehouse_id") != F.col("best.warehouse_id"), F.col("best.top_id")).otherwise(
        F.col("other_id")
    )
    return (
        staff.join(reach, "job_title")
        .filter(partner > F.col("employee_id"))
        .drop("best", "other_id")
        .orderBy("employee_id")
        .limit(limit)
    )

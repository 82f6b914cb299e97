"""What the optimizer makes of the plans: pruning, join kinds, no single-task step over facts."""

import pytest
from pyspark.sql import functions as F

from stockyard.operators.positions import place
from stockyard.plans import cases, customer, inventory, sales, views, warehouse, windows
from stockyard.sources.store import SnapshotStore
from stockyard.sources.tpch import load_tpch


@pytest.fixture(scope="module")
def ds(spark, tmp_path_factory):
    """Stored tables, and no broadcast, as if every side were large."""
    source = load_tpch(spark, "/root/testdata/sf0.001")
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("store")))
    store.commit({name: getattr(source, name) for name in source.names})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield store.dataset(source.as_of)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_recent_movements_open_only_their_months(ds):
    plan = physical(inventory.dead_stock(ds))
    assert "PartitionFilters: [isnotnull(movement_month" in plan and "movement_month" in plan.split("PartitionFilters")[1]
    assert "LeftAnti" in plan


def test_columns_and_filters_reach_the_scan(ds):
    plan = physical(sales.revenue_by_month(ds))
    assert "PushedFilters: [IsNotNull(status), Not(EqualTo(status,cancelled))" in plan
    assert "ReadSchema: struct<so_id:bigint,order_date:date,status:string>" in plan
    assert "ReadSchema: struct<so_id:bigint,quantity:int,unit_price:decimal(10,2),discount_pct:decimal(4,2)>" in plan


@pytest.mark.parametrize(
    "build",
    [
        sales.best_sellers,
        sales.revenue_by_category,
        customer.customer_ltv_top,
        customer.rfm,
        inventory.stockout_risk,
        inventory.inventory_aging,
        warehouse.employee_orders,
        windows.latest_order_per_customer,
        windows.order_gap,
        windows.first_last_price,
        cases.popular_understocked,
        cases.never_bought_by_wholesale,
        cases.same_title_pairs,
        views.inventory_status,
    ],
)
def test_no_single_task_and_no_pairs(ds, build):
    limited = build in (windows.latest_order_per_customer, windows.order_gap, windows.first_last_price, customer.rfm)
    plan = physical(build(ds, limit=None) if limited else build(ds))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_dominating_value_spreads_over_slots(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in place(df, F.col("v").asc(), F.col("id").asc()).groupBy("_slot").count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 1500

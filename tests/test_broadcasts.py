"""Tables that are small as files and large as rows do not go through the driver."""

from datetime import datetime

from pyspark.sql import functions as F

from stockyard.operators.commands import negative_stock
from stockyard.plans import matviews, serving
from stockyard.session import require_conf
from stockyard.sources.tpch import SOURCE_SCHEMAS, load_tpch


def test_stock_rows_of_a_compressed_table_are_not_broadcast(spark, tmp_path):
    root = str(tmp_path)
    part = spark.range(600_000).select(
        F.col("id").alias("p_partkey"), F.lit("a part").alias("p_name"), F.lit("Brand#11").alias("p_brand"),
        F.lit("STEEL").alias("p_type"), F.lit(1).alias("p_size"), F.lit(9.5).alias("p_retailprice"),
    )
    part.coalesce(1).write.parquet(f"{root}/part.parquet")
    for name in ("region", "nation", "supplier"):
        spark.createDataFrame([], SOURCE_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1.0")  # a session somebody else built
    require_conf(spark)
    plan = serving.below_reorder(load_tpch(spark, root, datetime(2001, 8, 2)))._jdf.queryExecution().executedPlan().toString()
    joined = next(line for line in plan.splitlines() if "Join [product_id" in line)
    assert "SortMergeJoin" in joined


def test_one_column_of_stock_rows_is_not_broadcast_either(spark, tmp_path):
    root = str(tmp_path)
    part = spark.range(200_000).select(
        F.col("id").alias("p_partkey"), F.lit("a part").alias("p_name"), F.lit("Brand#11").alias("p_brand"),
        F.lit("STEEL").alias("p_type"), F.lit(1).alias("p_size"), F.lit(9.5).alias("p_retailprice"),
    )
    part.coalesce(1).write.parquet(f"{root}/part.parquet")
    ds = load_tpch(spark, root, datetime(2001, 8, 2))
    deltas = spark.range(5_000_000).selectExpr("id as product_id", "id % 25 + 1 as warehouse_id", "-1 as delta")
    plan = negative_stock(ds.inventory, deltas)._jdf.queryExecution().executedPlan().toString()
    joined = next(line for line in plan.splitlines() if "Join [product_id" in line)
    assert "SortMergeJoin" in joined


def test_tasks_of_any_session_read_pieces_of_a_bounded_size(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    require_conf(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_orders_behind_supplier_metrics_are_not_broadcast(spark, tmp_path):
    def joined():
        plan = matviews.supplier_metrics(ds)._jdf.queryExecution().executedPlan().toString()
        return next(line for line in plan.splitlines() if "Join [po_id" in line)

    root, day = str(tmp_path), datetime(2000, 1, 1)
    orders = spark.range(200_000).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit(day).cast("timestamp_ntz").alias("o_orderdate"), F.lit("1").alias("o_orderpriority"),
    )
    lines = spark.range(200_000).select(
        F.col("id").alias("l_orderkey"), *[F.lit(1).cast("long").alias(c) for c in ("l_partkey", "l_suppkey")], F.lit(1).alias("l_linenumber"),
        *[F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        *[F.lit("N").alias(c) for c in ("l_returnflag", "l_linestatus")], F.lit(day).cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders.coalesce(1).write.parquet(f"{root}/orders.parquet")
    lines.coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    for name in ("region", "nation", "supplier", "customer"):
        spark.createDataFrame([], SOURCE_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    ds = load_tpch(spark, root, datetime(2001, 8, 2))
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1.0")  # as it was: 200,000 orders pass for small
    assert "BroadcastHashJoin" in joined()
    require_conf(spark)
    assert "SortMergeJoin" in joined()

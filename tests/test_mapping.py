"""The mapping at sizes the supplied tables do not have, and exact quotients."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockyard.functions.money import percent_of, quotient
from stockyard.operators.quality import validate
from stockyard.sources.tpch import SOURCE_SCHEMAS, load_tpch

LINE = "id, cast({part} as bigint), cast(0 as bigint), 1, cast(2 as double), 10.0D, 0.05D, 0.0D, 'N', 'O', timestamp_ntz '2000-01-01 00:00:00'"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """An order of 300,000 lines that all share one remainder, one of spread lines, and small ones behind them."""
    path = tmp_path_factory.mktemp("lines")
    parts = [
        spark.range(300_000).selectExpr("cast(7 as bigint) as id", "cast(61 as bigint) as p"),
        spark.range(140_000).selectExpr("cast(8 as bigint) as id", "id as p"),
        spark.range(400).selectExpr("9 + id div 200 as id", "id % 200 as p"),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    names = [c.split()[0] for c in SOURCE_SCHEMAS["lineitem"].split(", ")]
    rows.selectExpr(*[f"{e} as {n}" for e, n in zip(LINE.format(part="p").split(", "), names)]).write.parquet(
        f"{path}/lineitem.parquet"
    )
    return str(path)


def test_line_ids_never_meet(spark, folder):
    ids = load_tpch(spark, folder).sales_order_items.agg(F.count("*"), F.countDistinct("so_item_id"), F.min("so_item_id")).first()
    assert ids[0] == ids[1] == 440_400 and ids[2] >= 0


def test_ids_that_outgrow_64_bits_are_an_error(spark, folder, tmp_path):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("l_orderkey", F.col("l_orderkey") + 2**60)
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        load_tpch(spark, str(tmp_path)).sales_order_items.agg(F.max("so_item_id")).collect()


def test_plans_without_the_id_do_not_number_lines(spark):
    plan = load_tpch(spark, "/root/testdata/sf0.001").sales_order_items.groupBy("product_id").agg(F.sum("quantity"))
    assert "Window" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_capacity_is_wide(spark, make):
    row = {"warehouse_id": 1, "name": "w", "city": "c", "country": "d", "capacity_units": 180 * 10**9}
    ds = make(warehouses=[row])
    assert ds.warehouses.first().capacity_units == 180 * 10**9
    assert validate(ds).filter("table = 'warehouses' and kind = 'check' and violations > 0").isEmpty()


@pytest.mark.parametrize(
    "part,whole,digits,times,expected",
    [
        (12499999999, 10**11, 2, 1, "0.12"),
        (125, 1000, 2, 1, "0.13"),
        (-125, 1000, 2, 1, "-0.13"),
        (125, -1000, 2, 1, "-0.13"),
        (10**16, 3, 2, 1, "3333333333333333.33"),
        (1, 3, 1, 100, "33.3"),
        (2, 3, 3, 1, "0.667"),
        (0, 5, 2, 100, "0.00"),
    ],
)
def test_quotients(spark, part, whole, digits, times, expected):
    row = spark.range(1).select(quotient(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint"), digits, times).alias("q"))
    assert row.first().q == Decimal(expected)


def test_quotients_of_money(spark):
    cents = spark.range(1).select(F.lit("9999999999999999.99").cast("decimal(20,2)").alias("a"), F.lit("0.02").cast("decimal(4,2)").alias("b"))
    row = cents.select(quotient(F.col("b"), F.col("a"), 2, 100).alias("tiny"), percent_of(F.col("a"), F.col("a"), 2).alias("all"), percent_of(F.col("a"), F.col("a") - F.col("a"), 1).alias("none")).first()
    assert row.tiny == 0 and row.all == 100 and row.none is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        cents.select(quotient(F.col("a"), F.col("a") - F.col("a"), 1)).collect()

"""Steps that several named queries share are done once, and only for what is asked."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockyard.contract import operations
from stockyard.operators import commands
from stockyard.plans import deltas, matviews
from stockyard.sources.tpch import SOURCE_SCHEMAS, load_tpch, with_stored_lines
from stockyard.streaming.tables import LiveTables

DAY = datetime(2000, 1, 1)
ROWS = {
    "region": [(0, "R")],
    "nation": [(n, f"N{n}", 0) for n in range(25)],
    "customer": [(k, f"C{k}", k % 25, 1.0, "BUILDING") for k in range(30)],
    "supplier": [(k, f"S{k}", k % 25, 1.0) for k in range(4)],
    "part": [(k, f"P{k}", "Brand#11", "STEEL", k % 9, 900.0 + k) for k in range(20)],
    "orders": [(k, k % 30, "O", 1.0, DAY, "1") for k in range(60)],
    "lineitem": [(k, (k + n) % 20, k % 4, n, 5.0, 50.0, 0.1, 0.0, "N", "O", DAY) for k in range(60) for n in (1, 2, 2)],
    "events": [(k, DAY, k, "error", 1.0, "") for k in range(5)],
}


@pytest.fixture
def small(spark, tmp_path):
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, SOURCE_SCHEMAS[name]).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return load_tpch(spark, f"{tmp_path}/tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df):
    return sorted(map(str, df.collect()))


def test_lines_are_numbered_once_with_the_same_ids(small):
    ds, stored = small, with_stored_lines(small)
    assert with_stored_lines(ds) is stored
    for name in ("purchase_order_items", "sales_order_items"):
        assert counted(getattr(stored, name)) == counted(getattr(ds, name))
        assert "Window" in plan_of(getattr(ds, name)) and "Window" not in plan_of(getattr(stored, name))
    assert "Window" not in plan_of(stored.inventory_movements)


def test_differences_keep_rows_that_come_more_than_once(spark):
    class State:
        def __init__(self, *ids):
            self.products = spark.createDataFrame([(i,) for i in ids], "product_id long")

    net = deltas.difference(State(1, 1, 2, None), State(1, 3, 3, None), "products")["products"]
    assert {(r[0], r[1]) for r in net.signed().collect()} == {(1, -1), (2, -1), (3, 2)}


def test_one_summary_can_be_kept_alone(spark, small, tmp_path):
    summaries = deltas.LiveSummaries(spark, str(tmp_path / "live"), 4, ["mv_inventory_snapshot"])
    old = small.replace(inventory=small.inventory.filter("product_id % 5 <> 1").unionByName(small.inventory.filter("product_id = 2")))
    summaries.create(old)
    summaries.apply(1, old, small, deltas.difference(old, small, "inventory"))
    assert [p.name for p in (tmp_path / "live").iterdir()] == ["mv_inventory_snapshot"]
    assert counted(summaries.inventory_snapshot()) == counted(matviews.inventory_snapshot(small).select(*deltas._SNAPSHOT))


def test_a_whole_load_numbers_lines_once(small, monkeypatch):
    class Saved(Exception):
        pass

    def stop(*_):
        raise Saved

    plans = []
    monkeypatch.setattr(operations, "save_csv", lambda rows, path: plans.append(plan_of(rows)))
    monkeypatch.setattr(operations, "load_folder", stop)
    with pytest.raises(Saved):
        operations.whole_load(small)
    assert len(plans) == 12 and not any("Window" in plan for plan in plans)


def test_receipts_go_by_lines_found_before_and_orders_by_lines_kept(spark, small):
    ds = with_stored_lines(small)
    asked = ds.purchase_order_items.filter("po_id = 2").selectExpr("po_item_id as command_id", "po_item_id", "1000 as quantity")
    found = ds.purchase_order_items.select("po_item_id", "po_id", "product_id")
    kept = []

    def keep(items):
        kept.append(items)
        return items.withColumn("quantity_received", F.lit(0))

    judged = commands.receive_inventory(ds, asked, found.filter("po_id = 2"), keep)
    as_ever = commands.receive_inventory(ds, asked)
    assert counted(kept[0]) == counted(as_ever.tables["purchase_order_items"])
    assert counted(judged.tables["inventory"]) == counted(as_ever.tables["inventory"])
    assert counted(judged.tables["purchase_orders"]) == counted(ds.purchase_orders)
    assert counted(as_ever.tables["purchase_orders"]) != counted(ds.purchase_orders)
    assert commands.receive_inventory(ds, asked, found.limit(0)).rejects.count() == asked.count()


def test_lines_of_receipts_tell_their_product_without_the_lines_table(spark, small, tmp_path):
    tables = LiveTables(spark, str(tmp_path / "live"), 2)
    tables.create(with_stored_lines(small))
    found = small.purchase_order_items.select("po_item_id", "po_id", "product_id")
    assert counted(tables.order_of_line.rows()) == counted(found)


def test_sold_lines_are_shuffled_for_their_order_and_written_once(spark, small, tmp_path, monkeypatch):
    def never(*_, **__):
        raise AssertionError("lines are stored beside the table")

    tables = LiveTables(spark, str(tmp_path / "live"), 2)
    tables.create(small, purchases=False)
    monkeypatch.setattr("pyspark.sql.DataFrame.checkpoint", never)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", never)
    lines, orders = small.sales_order_items, small.sales_orders
    tables.sell(0, lines, orders.filter("so_id % 3 <> 0"), small.as_of)
    assert tables.waiting.of(0).count() == lines.filter("so_id % 3 = 0").count() > 0
    for _ in range(2):
        tables.sell(1, lines.limit(0), orders, small.as_of)
        assert counted(tables.sold_lines.rows()) == counted(lines) and tables.waiting.last(2).count() == 0
        held = commands.reserve_for_sales(small, lines).select("product_id", "warehouse_id", "quantity_reserved")
        assert counted(tables.inventory().select(*held.columns)) == counted(held)


def test_lines_of_a_stream_are_written_without_being_dealt_anew(spark, small, monkeypatch):
    plans = []
    write = type(small.sales_order_items).write
    monkeypatch.setattr(type(small.sales_order_items), "write", property(lambda df: plans.append(plan_of(df)) or write.fget(df)))
    tables = operations.sold(small)
    assert len(tables.placed_lines._numbers()) >= 2 and counted(tables.sold_lines.rows()) == counted(small.sales_order_items)
    assert plans and not any("RoundRobin" in plan for plan in plans)


def test_lines_of_the_change_log_meet_their_orders_once(small):
    log = operations.change_log(small)
    assert not [name for name, rows in log.items() if "Join" in plan_of(rows) or "Window" in plan_of(rows)]

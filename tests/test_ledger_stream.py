"""The ledger as a stream: early, late, repeated and unmatched changes."""

from datetime import date, datetime, timedelta

from conftest import rows_of

from stockyard.operators.ledger import LEDGER_COLUMNS
from stockyard.streaming import movements, rules
from pyspark.sql import functions as F

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)
NAMES = ("purchase_orders", "purchase_order_items", "sales_orders", "sales_order_items", "stock_transfers")


def deliver(spark, root, **tables):
    """Rows with their changed_at come as one part; the stream takes them up where it stopped."""
    streams = {}
    for name in NAMES:
        rows = tables.get(name, [])
        plain = rows_of(spark, name, [{k: v for k, v in row.items() if k != "at"} for row in rows])
        whole = spark.createDataFrame(
            [(*tuple(r), row["at"]) for r, row in zip(plain.collect(), rows)], plain.schema.add("changed_at", "timestamp_ntz")
        )
        whole.coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        streams[name] = spark.readStream.schema(whole.schema).parquet(f"{root}/{name}")
    query = movements.movement_stream(streams, f"{root}/ledger", f"{root}/cp", "7 days", "20 days")
    query.awaitTermination()
    return rules.dropped_lines(query)


def sale(so_id, status, at, ship=date(2024, 1, 5)):
    return {"so_id": so_id, "warehouse_id": 3, "status": status, "ship_date": ship, "at": at}


def line(item, so_id, at, quantity=4):
    return {"so_item_id": item, "so_id": so_id, "product_id": 8, "quantity": quantity, "at": at}


def test_a_movement_comes_once_whatever_comes_first(spark, tmp_path):
    root = str(tmp_path)
    transfer = {"transfer_id": 5, "product_id": 1, "from_warehouse_id": 1, "to_warehouse_id": 2, "quantity": 9,
                "transfer_date": date(2024, 1, 2), "status": "completed", "at": START}
    receipt = {"po_id": 1, "warehouse_id": 2, "status": "received", "actual_delivery_date": date(2024, 2, 3), "at": START + 2 * DAY}
    got = {"po_item_id": 11, "po_id": 1, "product_id": 7, "quantity_received": 6, "at": START + 3 * DAY}
    first = deliver(
        spark, root,
        sales_orders=[sale(1, "pending", START), sale(2, "shipped", START + DAY), sale(2, "delivered", START + 3 * DAY), sale(None, "shipped", START)],
        sales_order_items=[line(10, 1, START), line(10, 1, START), line(12, None, START), line(13, 1, None)],
        stock_transfers=[transfer, transfer, {**transfer, "transfer_id": 6, "status": "in_transit"}],
        purchase_orders=[{**receipt, "status": "shipped", "at": START}, receipt],
        purchase_order_items=[{**got, "quantity_received": 0, "at": START}, {**got, "po_item_id": 12, "quantity_received": 0}],
    )
    assert first == 0
    ids = lambda: sorted(r.movement_id for r in movements.ledger(spark, f"{root}/ledger").collect())
    assert ids() == [53, 54]  # no order that moves goods has a line yet
    second = deliver(
        spark, root,
        sales_orders=[sale(1, "shipped", START + 2 * DAY), sale(1, "shipped", START + 2 * DAY)],
        sales_order_items=[line(20, 2, START + DAY), line(21, 2, START + 2 * DAY)],
        stock_transfers=[transfer],
        purchase_order_items=[got, got],
    )
    assert second == 0
    assert ids() == [53, 54, 102, 111, 202, 212]
    found = {r.movement_id: tuple(r[c] for c in LEDGER_COLUMNS[1:]) for r in movements.ledger(spark, f"{root}/ledger").collect()}
    assert found[102] == (8, 3, "outbound", -4, 10, "sales_order", datetime(2024, 1, 5))
    assert found[111] == (7, 2, "inbound", 6, 11, "purchase_order", datetime(2024, 2, 3))
    assert found[53] == (1, 2, "transfer_in", 9, 5, "transfer", datetime(2024, 1, 2))
    assert found[54] == (1, 1, "transfer_out", -9, 5, "transfer", datetime(2024, 1, 2))


def test_too_late_rows_are_counted_and_state_goes(spark, tmp_path):
    root = str(tmp_path)
    later = START + 100 * DAY
    every = lambda at, n: {
        "sales_orders": [sale(n, "shipped", at)], "sales_order_items": [line(n, n, at)],
        "stock_transfers": [{"transfer_id": n, "status": "cancelled", "at": at}],
    }
    assert deliver(spark, root, **every(START, 1)) == 0
    assert deliver(spark, root, **every(later, 2)) == 0
    completed = {"transfer_id": 9, "product_id": 1, "from_warehouse_id": 1, "to_warehouse_id": 2, "quantity": 9,
                 "transfer_date": date(2024, 1, 2), "status": "completed"}
    third = {**every(later + DAY, 3), "stock_transfers": [{**completed, "at": later + DAY}]}
    assert deliver(spark, root, **third) == 0
    assert deliver(spark, root, sales_orders=[sale(4, "shipped", START + 2 * DAY)], sales_order_items=[line(4, 4, START + 2 * DAY)]) > 0
    ids = sorted(r.movement_id for r in movements.ledger(spark, f"{root}/ledger").collect())
    assert ids == [12, 22, 32, 93, 94]


def test_month_folders(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, root, sales_orders=[sale(1, "shipped", START)], sales_order_items=[line(1, 1, START)])
    plan = spark.read.parquet(f"{root}/ledger").filter(F.col("month") == "2024_01")
    assert plan.count() == 1 and "PartitionFilters: [isnotnull(month" in plan._jdf.queryExecution().toString()


def test_waiting_rows_are_not_kept_on_the_heap(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    deliver(spark, str(tmp_path), sales_order_items=[line(10, 1, START)])
    kept = {file.suffix for file in (tmp_path / "cp" / "state").rglob("*.*") if not file.name.startswith(".")}
    assert ".delta" not in kept and kept & {".zip", ".changelog"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_a_batch_commits_its_changes_alone(spark, tmp_path):
    deliver(spark, str(tmp_path), sales_order_items=[line(10, 1, START)])
    assert list((tmp_path / "cp" / "state").rglob("*.changelog")) and not list((tmp_path / "cp" / "state").rglob("*.sst"))

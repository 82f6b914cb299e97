"""Summaries (full = incremental) and streaming rules (stream = batch, replay = nothing)."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockyard.operators.commands import receive_inventory, reserve_for_sales
from stockyard.plans import deltas, matviews, serving, views
from stockyard.sources.store import SnapshotStore
from stockyard.sources.tpch import load_tpch
from stockyard.streaming import guard, rules
from stockyard.streaming.tables import LiveTables

SMALL = "/root/testdata/sf0.001"


def same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


@pytest.fixture(scope="module")
def ds(spark):
    return load_tpch(spark, SMALL)


def test_refresh_and_serve(spark, ds, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert serving.refresh_summaries(ds, store) == list(matviews.SUMMARIES)
    for name in ("mv_monthly_sales", "mv_supplier_metrics", "mv_warehouse_summary"):
        assert same(store.read(name), matviews.SUMMARIES[name].build(ds)), name
    assert store.manifest()["meta"]["refreshed_mv_dashboard_kpis"] == "2001-08-02 00:00:00"
    assert serving.respond("/dashboard/kpis", ds, store).count() == 1
    assert serving.respond("/analytics/products/top-selling", ds, store, limit=3).count() == 3
    assert serving.respond("/inventory/current", ds, store, product_id=7).count() == 5
    assert serving.respond("/inventory/below-reorder", ds, store).count() == 258
    assert serving.respond("/analytics/warehouses/utilization", ds, store).count() == 25
    assert serving.respond("/analytics/suppliers/performance", ds, store).count() > 0


def test_kpis_count_the_stored_snapshot(spark, ds, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    matviews.refresh(ds, store, "mv_inventory_snapshot")
    emptied = ds.replace(inventory=ds.inventory.withColumn("quantity_on_hand", F.lit(10_000)))
    matviews.refresh(emptied, store, "mv_dashboard_kpis")
    assert store.read("mv_dashboard_kpis").first().products_below_reorder == 258


def test_incremental_equals_full(spark, ds, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    early = ds.sales_orders.filter(F.col("order_date") < F.lit(date(2000, 1, 1)))
    late = ds.sales_orders.filter(F.col("order_date") >= F.lit(date(2000, 1, 1)))
    before = ds.replace(
        sales_orders=early,
        inventory=ds.inventory.withColumn(
            "quantity_on_hand", F.when(F.col("product_id") % 7 == 0, 0).otherwise(F.col("quantity_on_hand"))
        ),
        purchase_orders=ds.purchase_orders.filter((F.col("supplier_id") != 3) | (F.col("po_id") < 700)),
    )
    matviews.refresh_all(before, store)
    assert matviews.add_new_sales(store, ds.replace(sales_orders=late), 1)
    assert matviews.add_new_sales(store, ds.replace(sales_orders=late), 1) is None
    assert same(store.read("mv_monthly_sales"), matviews.monthly_sales(ds))
    matviews.patch_inventory(ds, store, ds.inventory.filter("product_id % 7 = 0"))
    assert same(store.read("mv_inventory_snapshot"), matviews.inventory_snapshot(ds))
    matviews.patch_suppliers(ds, store, ds.suppliers.filter("supplier_id = 3"))
    assert same(store.read("mv_supplier_metrics"), matviews.supplier_metrics(ds))
    matviews.patch_warehouses(ds, store, ds.warehouses)
    assert same(store.read("mv_warehouse_summary"), matviews.warehouse_summary(ds))


def test_summaries_follow_changes_and_write_what_they_touch(spark, ds, tmp_path):
    summaries = deltas.LiveSummaries(spark, str(tmp_path / "live"), 50)
    summaries.create(ds)
    one = ds.inventory.filter("product_id = 7")
    emptied = one.withColumn("quantity_on_hand", F.lit(0))
    stock = ds.inventory.filter("product_id != 7")
    later = ds.replace(inventory=stock.unionByName(emptied))
    written = summaries.apply(1, ds, later, {"inventory": deltas.Change(one, emptied)})
    assert len(written["mv_inventory_snapshot"]) == 1 and "mv_supplier_metrics" not in written
    assert same(summaries.inventory_snapshot(), matviews.inventory_snapshot(later))
    assert same(summaries.warehouse_summary(later), matviews.warehouse_summary(later))
    last = later.replace(
        inventory=stock,  # the rows go, those of a supplier's orders too
        purchase_orders=ds.purchase_orders.filter("supplier_id != 3"),
        suppliers=ds.suppliers,
    )
    gone = ds.purchase_orders.filter("supplier_id = 3")
    changes = {"inventory": deltas.Change(emptied, emptied.limit(0)), "purchase_orders": deltas.Change(gone, gone.limit(0))}
    for _ in range(2):
        written = summaries.apply(2, later, last, changes)
        assert len(written["mv_supplier_metrics"]) == 1
        assert same(summaries.inventory_snapshot(), matviews.inventory_snapshot(last))
        assert same(summaries.supplier_metrics(last), matviews.supplier_metrics(last))
        assert same(summaries.warehouse_summary(last), matviews.warehouse_summary(last))
    assert summaries.supplier_metrics(last).filter("supplier_id = 3").count() == 0 < summaries.supplier_metrics(ds).count()


def test_duplicate_key_is_not_published(spark, ds, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    twice = ds.replace(inventory=ds.inventory.unionByName(ds.inventory))
    with pytest.raises(ValueError, match="more than once"):
        matviews.refresh(twice, store, "mv_inventory_snapshot")
    assert not store.has("mv_inventory_snapshot")


def files(df, folder, parts):
    df.repartition(parts).write.parquet(folder)
    return folder


def folders(path):
    return {str(f.parent) for f in path.rglob("*.parquet")}


def test_reserve_stream_equals_batch_and_replays_safely(spark, ds, tmp_path):
    tables = LiveTables(spark, str(tmp_path / "s"), 8)
    tables.create(ds)
    new = ds.sales_order_items.filter("so_item_id % 2 = 1")
    folder = files(new, str(tmp_path / "in"), 3)
    source = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rules.reserve_stream(source, tables, lambda: ds.sales_orders, str(tmp_path / "cp"), lambda: ds.as_of).awaitTermination()
    expected = reserve_for_sales(ds, new)
    assert same(tables.inventory(), expected)
    assert same(tables.sold_lines.rows(), new)
    batches = [spark.read.schema(new.schema).parquet(f"{folder}/{f.name}") for f in sorted((tmp_path / "in").glob("*.parquet"))]
    for batch in batches:  # the last batch comes again
        if same(batch, tables.sold_lines.of(2)):
            tables.sell(2, batch, ds.sales_orders, ds.as_of)
    assert same(tables.inventory(), expected) and same(tables.sold_lines.rows(), new)


def test_lines_wait_for_their_order(spark, ds, tmp_path):
    tables = LiveTables(spark, str(tmp_path / "s"), 8)
    tables.create(ds)
    of = lambda *ids: ds.sales_order_items.filter(F.col("so_id").isin(*ids))
    tables.sell(0, of(5, 6), ds.sales_orders.filter("so_id != 5"), ds.as_of)
    assert same(tables.sold_lines.rows(), of(6)) and same(tables.waiting.of(0), of(5))
    for _ in range(2):
        tables.sell(1, of(7), ds.sales_orders, ds.as_of)
        assert same(tables.sold_lines.rows(), of(5, 6, 7)) and tables.waiting.last(2).count() == 0
        assert same(tables.inventory(), reserve_for_sales(ds, of(5, 6, 7)))


def test_receive_stream_equals_batch(spark, ds, tmp_path):
    tables = LiveTables(spark, str(tmp_path / "s"), 8)
    tables.create(ds)
    commands = ds.purchase_order_items.filter("quantity_received < quantity_ordered").selectExpr(
        "po_item_id as command_id", "po_item_id", "quantity_ordered - quantity_received as quantity"
    )
    commands = commands.unionByName(spark.createDataFrame([(10**12, 10**12, 5)], commands.schema))
    folder = files(commands, str(tmp_path / "in"), 2)
    source = spark.readStream.schema(commands.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rules.receive_stream(source, tables, str(tmp_path / "cp"), lambda: ds.as_of).awaitTermination()
    batch = receive_inventory(ds, commands)
    assert same(tables.purchase_orders.rows(), batch.tables["purchase_orders"])
    assert same(tables.purchase_order_items.rows(), batch.tables["purchase_order_items"])
    assert same(tables.inventory().drop("inventory_id"), batch.tables["inventory"].drop("inventory_id"))
    assert tables.inventory().select("inventory_id").distinct().count() == tables.inventory().count()
    moves, known = tables.movements.rows(), batch.appended["inventory_movements"]
    assert same(moves.drop("movement_id"), known.drop("movement_id"))
    assert {r[0] for r in moves.select("movement_id").collect()} == {r[0] for r in known.select("movement_id").collect()}
    assert [tuple(r) for r in tables.rejects.rows().collect()] == [(10**12, "unknown purchase line")]


def test_a_small_batch_writes_few_buckets_and_a_lost_one_comes_again(spark, ds, tmp_path):
    tables = LiveTables(spark, str(tmp_path / "s"), 200)
    tables.create(ds)
    before = {name: len(folders(tmp_path / "s" / name)) for name in ("levels", "purchase_orders", "purchase_order_items")}
    orders = [r[0] for r in ds.purchase_orders.select("po_id").orderBy("po_id").limit(3).collect()]
    batch = ds.purchase_order_items.filter(F.col("po_id").isin(orders)).selectExpr(
        "po_item_id as command_id", "po_item_id", "quantity_ordered as quantity"
    )
    tables.receive(0, batch, ds.as_of)
    for name, n in before.items():
        assert 0 < len(folders(tmp_path / "s" / name)) - n <= max(3, 0.1 * n), name
    expected = receive_inventory(ds, batch)
    state = tables.inventory().collect()
    for gone in [f for f in folders(tmp_path / "s" / "levels") if "_version=1" in f][:2]:
        Path(gone).rename(tmp_path / Path(gone).parent.name)  # only a part of the batch had been published
    tables.receive(0, batch, ds.as_of)
    assert Counter(map(repr, tables.inventory().collect())) == Counter(map(repr, state))
    assert same(tables.purchase_order_items.rows(), expected.tables["purchase_order_items"])
    plan = tables.levels.rows(buckets=[3, 4])._jdf.queryExecution().toString()
    assert "2 paths" in plan


def changes_by_force(rows, levels):
    out, levels = [], dict(levels)
    for change_id, at, product, warehouse, delta in sorted(rows, key=lambda r: (r[1], r[0])):
        level = levels.get((product, warehouse))
        good = level is not None and level + delta >= 0
        if good:
            levels[(product, warehouse)] = level = level + delta
        out.append((change_id, good, level))
    return Counter(out)


@pytest.mark.parametrize("split", [1, 3])
def test_guard_refuses_in_turn_whatever_the_files_and_after_a_restart(spark, tmp_path, split):
    rng, start = random.Random(3), datetime(2020, 1, 1)
    rows = [(i, start + timedelta(hours=i // 2), 1 + i % 3 % 2, 1 + i % 5 // 4, rng.choice([-4, -2, 3])) for i in range(120)]
    rows += [(500, start + timedelta(hours=7), 9, 9, 1)]
    levels = {(1, 1): 5, (2, 1): 0, (1, 2): 3}
    schema = "change_id long, changed_at timestamp_ntz, product_id long, warehouse_id long, delta int"
    stock = spark.createDataFrame([(*k, v) for k, v in levels.items()], "product_id long, warehouse_id long, quantity_on_hand int")
    order = sorted(rows, key=lambda r: (r[1] + timedelta(hours=rng.randrange(20))))
    folder, out, progress = (str(tmp_path / name) for name in ("in", "out", "cp"))
    ends = [0, *(len(order) * k // (2 * split) for k in range(1, 2 * split + 1))]
    for half in range(2):
        for a, b in list(zip(ends, ends[1:]))[half * split : (half + 1) * split]:
            spark.createDataFrame(order[a:b], schema).coalesce(1).write.mode("append").parquet(folder)
        if half:
            spark.createDataFrame([(None, datetime(2200, 1, 1), None, None, None)], schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        query = guard.guard_stream(source, stock, out, progress, "2 days", slots=3)
        query.awaitTermination()
        assert rules.dropped_lines(query) == 0
    got = guard.outcomes(spark, out).collect()
    assert Counter((r.change_id, r.accepted, r.quantity_after) for r in got) == changes_by_force(rows, levels)
    assert {r.reason for r in got} == {None, guard.BELOW_ZERO, guard.NO_ROW}
    assert (tmp_path / "out" / "accepted=false").exists()  # refused ones lie apart


def run_to_table(df, mode, name):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def test_live_revenue_equals_batch(spark, ds, tmp_path):
    dates = ds.sales_orders.select("so_id", F.col("order_date").cast("timestamp_ntz").alias("ordered_at"))
    lines = ds.sales_order_items.join(dates, "so_id")
    folder = files(lines, str(tmp_path / "in"), 1)
    source = spark.readStream.schema(lines.schema).parquet(folder)
    months = run_to_table(rules.live_monthly_revenue(source, ds.sales_orders), "complete", "live_months")
    assert same(months, matviews.monthly_sales(ds).drop("order_count"))
    days = run_to_table(rules.live_daily_revenue(source, ds.sales_orders), "update", "live_days")
    assert same(days, views.daily_revenue(ds))


def test_negative_stock_stream(spark, ds, tmp_path):
    deltas = spark.createDataFrame([(1, 1, -5), (2, 2, -100_000), (2, 2, 10)], "product_id long, warehouse_id long, delta int")
    folder = files(deltas, str(tmp_path / "in"), 1)
    source = spark.readStream.schema(deltas.schema).parquet(folder)
    stock = spark.createDataFrame([(1, 1, 5), (2, 2, 7)], "product_id long, warehouse_id long, quantity_on_hand int")
    out = run_to_table(rules.negative_stock_stream(source, stock), "update", "negative_stock").collect()
    assert [(r.product_id, r.quantity_after) for r in out] == [(2, -99_983)]


class _CountedState:
    """State of one slot in memory; counts the calls to it."""

    def __init__(self):
        self.calls, self.kept, self.items = 0, {}, []

    def getValue(self, key):
        self.calls += 1
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.kept[key] = value

    def get(self):
        self.calls += 1
        return iter(list(self.items))

    def appendValue(self, value):
        self.calls += 1
        self.items.append(value)

    def clear(self):
        self.calls += 1
        self.items = []


class _CountedHandle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _CountedState())

    getListState = getMapState

    def getValueState(self, name, _):
        class Timer:
            at = None
            exists = lambda self: self.at is not None
            get = lambda self: self.at

            def update(self, value):
                self.at = value

            def clear(self):
                self.at = None

        return Timer()

    def registerTimer(self, at):
        pass

    deleteTimer = registerTimer


def test_guard_packs_its_state_and_levels_come_in_several_frames():
    """The cost of a slot in calls to the state does not follow its pairs or changes."""
    handle, pairs = _CountedHandle(), 3_000
    slot = guard.StockGuard()
    slot.init(handle)
    stock = pd.DataFrame({"product_id": range(pairs), "warehouse_id": 1, "quantity_on_hand": 1})
    for frame in (stock[:1000], stock[1000:]):
        slot.handleInitialState((0,), frame, None)
    changes = pd.DataFrame(
        {"change_id": range(2 * pairs), "product_id": [*range(pairs)] * 2, "warehouse_id": 1, "delta": -1,
         "changed_at": pd.Timestamp(2024, 1, 2)}
    )
    assert list(slot.handleInputRows((0,), iter([changes]), None)) == []
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: pd.Timestamp(2024, 1, 3).value // 10**6})()
    told = pd.concat(slot.handleExpiredTimer((0,), now, None))
    assert told.groupby("change_id")["accepted"].first().tolist() == [True] * pairs + [False] * pairs
    assert (told["quantity_after"] == 0).all()
    assert sum(state.calls for state in handle.states.values()) < 10 * guard.BINS

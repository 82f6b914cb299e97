"""CSV rules, versioned store, month-partitioned ledger."""

import random
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockyard.operators.ledger import derive_movements
from stockyard.schema import LOAD_ORDER
from stockyard.sources.csv import as_dictionaries, load_folder, next_ids, read_csv, save_csv
from stockyard.sources.store import LEDGER, SnapshotStore, VersionConflict, repartition_ledger
from stockyard.sources.tpch import load_tpch

NOW = datetime(2024, 6, 1, 12)
SMALL = "/root/testdata/sf0.001"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_header_order_nulls_and_defaults(spark, tmp_path):
    path = write(
        tmp_path / "products.csv",
        'name,product_id,sku,category_id,supplier_id,unit_cost,unit_price,reorder_qty\n'
        '"a, ""b""",1,S1,1,1,2.50,10,\n'
        '"",2,,1,1,1,2.345,7\n',
    )
    rows = read_csv(spark, "products", path, NOW).orderBy("product_id").collect()
    assert rows[0].name == 'a, "b"' and rows[0].reorder_qty is None  # written NULL is kept
    assert rows[0].reorder_level == 10 and rows[0].created_at == NOW  # absent columns default
    assert rows[1].name == "" and rows[1].sku is None
    assert rows[0].unit_price == Decimal("10.00")


def test_csv_bad_value_or_column_aborts(spark, tmp_path):
    bad = write(tmp_path / "bad.csv", "category_id,name\n1,x\nxx,y\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, "product_categories", bad, NOW).collect()
    quoted = write(tmp_path / "quoted.csv", 'category_id,name,parent_category_id\n1,x,""\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, "product_categories", quoted, NOW).collect()
    unknown = write(tmp_path / "unknown.csv", "category_id,name,colour\n1,x,red\n")
    with pytest.raises(ValueError, match="colour"):
        read_csv(spark, "product_categories", unknown, NOW)


@pytest.fixture
def tiny_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_quotes_read_by_many_tasks(spark, tmp_path, tiny_blocks, end):
    rng = random.Random(end)
    for file in range(3):
        rows = []
        for i in range(40):
            name = "".join(rng.choice(['a', 'é', '\n', '"', ',', ' ', 'word', '\n\n']) for _ in range(rng.choice([0, 3, 9, 200])))
            rows.append(f"{100 * file + i},{quoted('x' + name + 'y') if i % 4 else 'plain'},{rng.choice(['', '7'])}")
        path = tmp_path / "in" / f"{file}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text(f"category_id,name,parent_category_id{end}" + end.join([*rows[:20], "", *rows[20:]]) + end * (file % 2), newline="")
    folder = str(tmp_path / "in")
    got = read_csv(spark, "product_categories", folder, NOW, multi_line=True)
    plain = spark.read.csv(folder, schema="category_id long, name string, parent_category_id long", header=True, multiLine=True, escape='"')
    rows = sorted(map(repr, got.select("category_id", "name", "parent_category_id").collect()))
    assert rows == sorted(map(repr, plain.collect())) and len(rows) == 120
    size = sum(f.stat().st_size for f in Path(folder).glob("*.csv"))
    assert spark.read.text(folder).rdd.getNumPartitions() >= size // 97


def test_bad_quoted_files_fail(spark, tmp_path, tiny_blocks):
    bad = write(tmp_path / "bad.csv", 'category_id,name\n1,"x\ny"\nxx,"y\nz"\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, "product_categories", bad, NOW, multi_line=True).collect()
    unclosed = write(tmp_path / "unclosed.csv", 'category_id,name\n1,"x\ny\n2,z\n')
    with pytest.raises(ValueError, match="stay open in 1 files"):
        read_csv(spark, "product_categories", unclosed, NOW, multi_line=True)
    (tmp_path / "two").mkdir()
    write(tmp_path / "two" / "a.csv", "category_id,name\n1,x\n")
    write(tmp_path / "two" / "b.csv", "category_id,parent_category_id\n2,3\n")
    with pytest.raises(Exception, match="different headers"):
        read_csv(spark, "product_categories", str(tmp_path / "two"), NOW, multi_line=True).collect()
    empty = write(tmp_path / "empty.csv", "category_id,name\n")
    assert read_csv(spark, "product_categories", empty, NOW, multi_line=True).collect() == []


def test_load_is_all_or_nothing(spark, tmp_path):
    ds = load_tpch(spark, SMALL)
    good, bad = tmp_path / "good", tmp_path / "bad"
    for name in LOAD_ORDER:
        df = getattr(ds, name)
        save_csv(df, str(good / f"{name}.csv"))
        if name == "inventory":
            df = df.withColumn("quantity_on_hand", F.col("quantity_on_hand") - 5)
        save_csv(df, str(bad / f"{name}.csv"))
    store = SnapshotStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="inventory.on_hand_not_negative"):
        load_folder(spark, str(bad), store, ds.as_of)
    assert store.manifest()["version"] == 0
    load_folder(spark, str(good), store, ds.as_of)
    assert store.manifest()["version"] == 1
    loaded = store.dataset(ds.as_of)
    for name in ("sales_order_items", "customers", "purchase_orders", "suppliers"):
        assert getattr(loaded, name).exceptAll(getattr(ds, name)).isEmpty(), name
    ids = {r.table: r.last_id for r in next_ids(loaded).collect()}
    assert ids["sales_orders"] == 1500 and len(ids) == 12


def test_store_versions(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    with pytest.raises(KeyError):
        store.read("numbers")
    store.commit({"numbers": spark.range(3)})
    old = store.read("numbers")
    store.commit({"numbers": spark.range(5)}, {"note": "x"})
    assert old.count() == 3 and store.read("numbers").count() == 5
    staged = store.stage({"numbers": spark.range(9)})
    assert store.read("numbers").count() == 5  # staged is not published
    assert staged["numbers"] not in store.manifest()["tables"].values()
    assert len(store.expire()) == 2 and store.read("numbers").count() == 5
    assert store.manifest()["meta"] == {"note": "x"} and store.manifest()["version"] == 2


def test_ledger_months_are_pruned(spark, tmp_path):
    ds = load_tpch(spark, SMALL)
    store = SnapshotStore(spark, str(tmp_path / "s"))
    repartition_ledger(store, derive_movements(ds))
    folder = store.manifest()["tables"][LEDGER]
    assert len([p for p in __import__("os").listdir(folder) if p.startswith("movement_month=")]) > 70
    start, end = date(2001, 3, 5), date(2001, 4, 2)
    part = store.ledger_between(start, end)
    wanted = derive_movements(ds).filter((F.col("movement_date") >= F.lit(start)) & (F.col("movement_date") < F.lit(end)))
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, wanted.collect()))
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(movement_month" in plan
    files = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
    assert {f.split("movement_month=")[1][:7] for f in files} == {"2001-03", "2001-04"}


def test_rows_as_json(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b")
    assert [r.value for r in as_dictionaries(df).collect()] == ['{"a":1,"b":null}']


def test_recent_sales_open_recent_months_only(spark, tmp_path):
    from stockyard.plans import kpi, matviews

    ds = load_tpch(spark, SMALL)
    store = SnapshotStore(spark, str(tmp_path / "s"))
    names = ("sales_orders", "sales_order_items", "products", "inventory", "purchase_orders", "suppliers", "warehouses")
    store.commit({name: getattr(ds, name) for name in names})
    kept = store.dataset(ds.as_of)
    for plan in (kpi.kpi_snapshot, kpi.inventory_turnover, matviews.dashboard_kpis):
        result = plan(kept)
        text = result._jdf.queryExecution().toString()
        assert text.count("PartitionFilters: [isnotnull(order_month") >= 2, plan
        assert list(map(tuple, result.collect())) == list(map(tuple, plan(ds).collect()))


def test_second_writer_of_a_version_fails(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.commit({"numbers": spark.range(3)})
    a, b = store.stage({"numbers": spark.range(4)}), store.stage({"numbers": spark.range(5)})
    store.publish(a)
    with pytest.raises(VersionConflict):
        store.publish(b)
    assert store.read("numbers").count() == 4
    tries = []

    def step(current):
        staged = store.stage({"numbers": spark.range(10 + len(tries))}, current)
        if not tries:
            store.commit({"other": spark.range(1)})  # somebody is faster once
        tries.append(current["version"])
        return store.publish(staged)

    assert store.retried(step) == 4 and tries == [2, 3]
    assert store.read("numbers").count() == 11 and store.has("other")

"""Appended batches against the check of the whole, and distinct counts from bitmaps."""

import random
from collections import Counter
from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.operators.appends import KeyBook, check_append
from stockyard.operators.quality import validate
from stockyard.plans import distincts

NOW = datetime(2024, 6, 1)


def person(i, email, manager=None, place=1):
    return {"employee_id": i, "warehouse_id": place, "manager_id": manager, "first_name": "A", "last_name": "B", "email": email,
            "job_title": "t", "hire_date": date(2020, 1, 1), "created_at": NOW}


def booked(spark, path, ds, *tables, **options):
    book = KeyBook(spark, str(path), **options)
    for table in tables:
        book.record(table, getattr(ds, table))
    return book


def whole(ds, table, batch):
    """Rules of the table in the whole report."""
    report = validate(ds.replace(**{table: getattr(ds, table).unionByName(batch)}))
    return Counter(map(tuple, report.filter(F.col("table") == table).collect()))


PLACES = [{"warehouse_id": i, "name": f"W{i}", "city": "c", "country": "x", "capacity_units": 9, "created_at": NOW} for i in (1, 2, 40_000)]


@pytest.mark.parametrize("bits", [1 << 30, 64])  # a filter that tells keys apart, and one that is nearly full
def test_append_equals_the_whole_check(spark, make, tmp_path, bits):
    stored = [person(i, f"e{i}", manager=1 if i > 1 else None) for i in range(1, 60)] + [person(-7, "minus"), person(10**12, "far")]
    ds = make(NOW, employees=stored, warehouses=PLACES)
    batch = rows_of(spark, "employees", [
        person(5, "new1"),  # id taken
        person(100, "e3"), person(101, "e3"),  # text taken, twice
        person(102, "twin"), person(102, "twin"), person(102, "twin"),  # repeated in the batch alone
        person(103, None), person(None, "noid"), person(-7, "minus2"),
        person(104, "boss", manager=105), person(105, "peer", manager=104),  # refer to each other
        person(106, "lost", manager=9999), person(107, "lost2", manager=-8), person(108, "far2", manager=10**12, place=40_000),
        person(109, "nowhere", place=3), person(110, "nowhere2", place=None), person(111, "x" * 200),
    ])
    book = booked(spark, tmp_path / "k", ds, "employees", "warehouses", bits=bits)
    got = Counter(map(tuple, check_append(ds, "employees", batch, book).collect()))
    assert got == whole(ds, "employees", batch)
    assert {row[1]: row[3] for row in got}["email_unique"] == 4
    empty = Counter(map(tuple, check_append(ds, "employees", batch.limit(0), book).collect()))
    assert empty == whole(ds, "employees", batch.limit(0))


def test_composite_keys_and_a_third_of_one_key(spark, make, tmp_path):
    rng = random.Random(4)
    row = lambda i, p, w: {"inventory_id": i, "product_id": p, "warehouse_id": w, "quantity_on_hand": 5, "quantity_reserved": 0, "last_updated": NOW}
    ds = make(NOW, inventory=[row(p * 10 + w, p, w) for p in range(1, 9) for w in (1, 2)], warehouses=PLACES, products=[{"product_id": p} for p in range(1, 10)])
    new = [row(1000 + i, 77 if i % 3 == 0 else rng.randint(1, 12), rng.choice((1, 2, None))) for i in range(90)]
    batch = rows_of(spark, "inventory", new)
    book = booked(spark, tmp_path / "k", ds, "inventory", "warehouses", "products")
    assert Counter(map(tuple, check_append(ds, "inventory", batch, book).collect())) == whole(ds, "inventory", batch)


def test_the_stored_table_is_opened_only_for_keys_the_filter_may_hold(spark, make, tmp_path):
    ds = make(NOW, employees=[person(i, f"e{i}") for i in range(1, 20)], warehouses=PLACES)
    book = booked(spark, tmp_path / "k", ds, "employees", "warehouses")
    opened = []
    watched = Dataset(spark, {"employees": lambda: opened.append(1) or ds.employees, "warehouses": lambda: opened.append(2)}, NOW)
    check_append(watched, "employees", rows_of(spark, "employees", [person(50, "fresh", 3)]), book).collect()
    assert not opened
    check_append(watched, "employees", rows_of(spark, "employees", [person(50, "e7", 3)]), book).collect()
    assert opened == [1]


def test_batches_add_up_and_come_again(spark, make, tmp_path):
    ds = make(NOW, employees=[person(i, f"e{i}") for i in range(1, 40)])
    once, parts = booked(spark, tmp_path / "a", ds, "employees"), KeyBook(spark, str(tmp_path / "b"))
    for number in (0, 1, 2, 1):
        parts.record("employees", ds.employees.filter(F.col("employee_id") % 3 == number), number)
    compact = KeyBook(spark, str(tmp_path / "c"))
    parts.compact("employees", compact)
    sets = [Counter((r.key_name, r.piece, bytes(r.bits)) for r in b.pieces("employees").collect()) for b in (once, parts, compact)]
    assert sets[0] == sets[1] == sets[2]


def test_distinct_ids_of_any_range(spark, tmp_path):
    rng = random.Random(8)
    ids = [None, 0, -1, -40_000, 7, 32_767, 32_768, 10**15, *range(1, 30)]
    rows = [
        (rng.choice(ids), rng.choice(ids) if i % 3 else 7, i, rng.choice(("cancelled", "shipped", None)),
         None if i % 50 == 0 else date(2023, rng.randint(1, 12), rng.randint(1, 28)))
        for i in range(400)
    ]
    orders = spark.createDataFrame(rows, "customer_id long, employee_id long, so_id long, status string, order_date date")
    path = str(tmp_path / "ids")
    distincts.write_months(distincts.month_bitmaps(orders.filter("month(order_date) <> 5 or so_id % 2 = 0"), "order_date"), path)
    distincts.write_months(distincts.month_bitmaps(orders.filter("month(order_date) = 5"), "order_date"), path)
    kept = distincts.stored_months(spark, path)
    for first, until in ((1, 12), (5, 6), (4, 9)):
        inside = [r for r in rows if r[4] and first <= r[4].month < until]
        expected = {
            "customers": {r[0] for r in inside}, "employees": {r[1] for r in inside}, "orders": {r[2] for r in inside},
            "active_customers": {r[0] for r in inside if r[3] == "shipped"}, "cancelling_customers": {r[0] for r in inside if r[3] == "cancelled"},
        }
        got = distincts.distinct_counts(kept, date(2023, first, 1), date(2023, until, 1))
        assert {r.measure: r.distinct_ids for r in got.collect()} == {k: len(v - {None}) for k, v in expected.items()}
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert distincts.distinct_counts(distincts.month_bitmaps(orders.limit(0), "order_date")).count() == 0

"""Batch commands against literal cases and an in-order brute force."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from stockyard.operators.commands import (
    create_purchase_orders,
    receive_inventory,
    reserve_for_sales,
    transfer_stock,
    update_stock,
)

NOW = datetime(2024, 6, 1, 12)


def as_dict(df, key, *columns):
    return {tuple(r[k] for k in key): tuple(r[c] for c in columns) for r in df.collect()}


def stock(*rows):
    return [
        {
            "inventory_id": i + 1,
            "product_id": p,
            "warehouse_id": w,
            "quantity_on_hand": q,
            "quantity_reserved": r,
            "last_updated": datetime(2024, 1, 1),
        }
        for i, (p, w, q, r) in enumerate(rows)
    ]


@pytest.fixture
def purchase(make):
    def order(po, warehouse, status, actual=None):
        return {
            "po_id": po,
            "supplier_id": 1,
            "warehouse_id": warehouse,
            "employee_id": 1,
            "order_date": date(2024, 5, 1),
            "status": status,
            "actual_delivery_date": actual,
        }

    def line(item, po, product, ordered, received):
        return {
            "po_item_id": item,
            "po_id": po,
            "product_id": product,
            "quantity_ordered": ordered,
            "quantity_received": received,
            "unit_cost": Decimal("1.00"),
        }

    return make(
        NOW,
        purchase_orders=[
            order(1, 1, "shipped"),
            order(2, 2, "cancelled", date(2024, 5, 20)),
            order(3, 1, "pending"),
        ],
        purchase_order_items=[
            line(10, 1, 100, 5, 0),
            line(11, 1, 101, 5, 5),
            line(20, 2, 100, 3, 0),
            line(30, 3, 102, 9, 0),
        ],
        inventory=stock((100, 1, 7, 0), (102, 2, 1, 1)),
    )


def test_receive(spark, purchase):
    commands = spark.createDataFrame(
        [(1, 10, 2), (2, 10, 4), (3, 20, 3), (4, 99, 1), (5, 30, -1), (6, 30, 2)],
        "command_id long, po_item_id long, quantity int",
    )
    out = receive_inventory(purchase, commands)
    items = as_dict(out.tables["purchase_order_items"], ["po_item_id"], "quantity_received")
    assert items == {(10,): (6,), (11,): (5,), (20,): (3,), (30,): (2,)}  # line 10 over-received
    orders = as_dict(out.tables["purchase_orders"], ["po_id"], "status", "actual_delivery_date")
    assert orders[(1,)] == ("received", date(2024, 6, 1))
    assert orders[(2,)] == ("received", date(2024, 5, 20))  # cancelled completes, date kept
    assert orders[(3,)] == ("pending", None)
    levels = as_dict(out.tables["inventory"], ["product_id", "warehouse_id"], "quantity_on_hand", "last_updated")
    assert levels[(100, 1)] == (13, NOW)
    assert levels[(100, 2)] == (3, NOW) and levels[(102, 1)] == (2, NOW)
    assert levels[(102, 2)] == (1, datetime(2024, 1, 1))
    assert {r.inventory_id for r in out.tables["inventory"].collect()} == {1, 2, 3, 4}
    rejects = as_dict(out.rejects, ["command_id"], "reason")
    assert rejects == {(4,): ("unknown purchase line",), (5,): ("negative quantity",)}
    moves = [(r.movement_id, r.reference_id, r.quantity) for r in out.appended["inventory_movements"].collect()]
    assert sorted(moves) == [(1, 10, 2), (2, 10, 4), (3, 20, 3), (4, 30, 2)]


def test_receive_split_batch_is_the_same(spark, purchase):
    schema = "command_id long, po_item_id long, quantity int"
    rows = [(1, 10, 2), (2, 10, 3), (3, 20, 1), (4, 30, 9)]
    whole = receive_inventory(purchase, spark.createDataFrame(rows, schema)).apply(purchase)
    half = receive_inventory(purchase, spark.createDataFrame(rows[:2], schema)).apply(purchase)
    split = receive_inventory(half, spark.createDataFrame(rows[2:], schema)).apply(half)
    for table in ("purchase_order_items", "purchase_orders", "inventory"):
        drop = ["inventory_id"] if table == "inventory" else []
        a, b = getattr(whole, table).drop(*drop), getattr(split, table).drop(*drop)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())), table


def transfer_by_hand(levels, known_staff, known_places, commands):
    levels = dict(levels)
    accepted, rejected = [], set()
    for cid, _, p, a, b, q, e in sorted(commands, key=lambda c: (c[1], c[0])):
        have = levels.get((p, a))
        if have is None or have < q or q <= 0 or a == b or e not in known_staff or b not in known_places:
            rejected.add(cid)
            continue
        levels[(p, a)] -= q
        levels[(p, b)] = levels.get((p, b), 0) + q
        accepted.append(cid)
    return levels, accepted, rejected


def places(n):
    return [{"warehouse_id": i, "name": f"W{i}", "city": "c", "country": "x", "capacity_units": 9} for i in range(1, n + 1)]


STAFF = [{"employee_id": 1, "warehouse_id": 1, "first_name": "A", "last_name": "B", "email": "a", "job_title": "t"}]
TRANSFER = (
    "command_id long, command_ts timestamp_ntz, product_id long, from_warehouse_id long, to_warehouse_id long, "
    "quantity int, employee_id long"
)


def check_transfer(spark, ds, initial, commands, n_places):
    out = transfer_stock(ds, spark.createDataFrame(commands, TRANSFER))
    levels, accepted, rejected = transfer_by_hand(initial, {1}, set(range(1, n_places + 1)), commands)
    got = {(r.product_id, r.warehouse_id): r.quantity_on_hand - r.quantity_reserved for r in out.tables["inventory"].collect()}
    assert {k: v for k, v in got.items()} == levels
    assert {r.command_id for r in out.rejects.collect()} == rejected
    records = sorted(out.appended["stock_transfers"].collect(), key=lambda r: r.transfer_id)
    by_id = {c[0]: c for c in commands}
    assert [(r.product_id, r.from_warehouse_id, r.to_warehouse_id, r.quantity) for r in records] == [
        by_id[i][2:6] for i in accepted
    ]
    moves = out.appended["inventory_movements"].collect()
    assert len(moves) == 2 * len(accepted) and sum(r.quantity for r in moves) == 0
    assert len({r.movement_id for r in moves}) == len(moves)
    return out


def test_transfer_cases(spark, make):
    ds = make(NOW, inventory=stock((1, 1, 10, 4), (1, 2, 0, 0), (2, 1, 5, 0)), warehouses=places(3), employees=STAFF)
    at = datetime(2024, 6, 1)
    commands = [
        (1, at, 1, 1, 2, 6, 1),  # exactly what is available
        (2, at, 1, 1, 2, 1, 1),  # nothing left
        (3, at, 1, 2, 3, 6, 1),  # needs the first
        (4, at, 1, 3, 3, 1, 1),  # same warehouse
        (5, at, 2, 1, 2, 0, 1),  # no quantity
        (6, at, 2, 2, 1, 1, 1),  # nothing there yet
        (7, at, 2, 1, 9, 1, 1),  # unknown warehouse
        (8, at, 2, 1, 3, 1, 7),  # unknown employee
        (9, at, 3, 1, 2, 1, 1),  # no inventory row at all
        (10, at, 2, 1, 2, 5, 1),
    ]
    out = check_transfer(spark, ds, {(1, 1): 6, (1, 2): 0, (2, 1): 5}, commands, 3)
    reasons = {r.command_id: r.reason for r in out.rejects.collect()}
    assert reasons[4] == "same warehouse" and reasons[5] == "quantity not positive"
    assert reasons[7] == "unknown warehouse" and reasons[8] == "unknown employee"
    assert reasons[2] == reasons[6] == reasons[9] == "insufficient stock"


@pytest.mark.parametrize(("seed", "count"), [(1, 200), (2, 40)])
def test_transfer_matches_one_by_one(spark, no_coalescing, make, seed, count):
    """One product takes most commands and both directions compete for little stock."""
    rng = random.Random(seed)
    rows = [(p, w, rng.randint(0, 60), 0) for p in (1, 2, 3) for w in (1, 2, 3) if rng.random() < 0.8]
    ds = make(NOW, inventory=stock(*rows), warehouses=places(4), employees=STAFF)
    commands = []
    for i in range(1, count + 1):
        product = 1 if rng.random() < 0.7 else rng.choice((2, 3))
        a, b = rng.sample((1, 2, 3, 4), 2)
        commands.append((i, datetime(2024, 6, 1, rng.randint(0, 3)), product, a, b, rng.randint(1, 30), 1))
    check_transfer(spark, ds, {(p, w): q for p, w, q, _ in rows}, commands, 4)


@pytest.fixture
def walks(monkeypatch):
    """The rounds it takes to find what slots open with."""
    from stockyard.operators import commands as module

    found, fold = [], module._fold

    def counted(commands, opening, schema, walk):
        if walk is module._summaries:
            found.append(1)
        return fold(commands, opening, schema, walk)

    monkeypatch.setattr(module, "_fold", counted)
    return found


def test_one_unit_passed_back_and_forth(spark, no_coalescing, make, walks):
    ds = make(NOW, inventory=stock((1, 1, 1, 0), (1, 2, 0, 0)), warehouses=places(2), employees=STAFF)
    at = datetime(2024, 6, 1)
    commands = [(i, at, 1, 1 + i % 2, 2 - i % 2, 1, 1) for i in range(10_000)]
    check_transfer(spark, ds, {(1, 1): 1, (1, 2): 0}, commands, 2)
    assert 1 <= len(walks) <= 4  # four slots; one round if they happen to open as guessed


@pytest.mark.parametrize(("level", "most"), [(60, 24), (200_000, 4)])
def test_a_dominating_product_over_many_slots(spark, no_coalescing, make, walks, level, most):
    """A third of the commands concern one product; with scarce stock every outcome hangs on the ones before."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    rng = random.Random(level)
    rows = [(p, w, rng.randint(0, level), 0) for p in range(1, 31) for w in range(1, 6)]
    ds = make(NOW, inventory=stock(*rows), warehouses=places(5), employees=STAFF)
    commands = []
    for i in range(6000):
        a, b = rng.sample(range(1, 6), 2)
        commands.append((i, datetime(2024, 6, 1, i % 24), 1 if i % 3 == 0 else rng.randint(2, 30), a, b, rng.randint(1, 40), 1))
    check_transfer(spark, ds, {(p, w): q for p, w, q, _ in rows}, commands, 5)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    print("rounds", len(walks))
    assert 1 <= len(walks) <= most


def test_the_outcome_of_a_slot_holds_within_its_range_only():
    """Against settling the same commands from every opening level."""
    import pandas as pd

    from stockyard.operators.commands import _STEP, _outcomes, _summaries

    rng = random.Random(9)
    steps = []
    for _ in range(30):
        a, b = rng.sample((1, 2, 3), 2)
        steps.append((7, 2, 1, a, b, rng.randint(1, 9), 0))

    def walked(levels):
        frame = pd.DataFrame([(7, 2, 0, w, 0, 0, q) for w, q in levels.items()] + steps, columns=list(_STEP))
        accepted = pd.concat(_outcomes(["accepted"])(iter([frame.iloc[:9], frame.iloc[9:]])))["accepted"].tolist()
        told = pd.concat(_summaries(iter([frame.iloc[:9], frame.iloc[9:]]))).set_index("warehouse_id")
        return accepted, {w: tuple(told.loc[w, ["flow", "low", "high"]]) for w in levels}

    base = {1: 6, 2: 9, 3: 4}
    accepted, told = walked(base)
    for w, (flow, low, high) in told.items():
        moved = sum((s[5] if s[4] == w else -s[5]) for s, good in zip(steps, accepted) if good and w in s[3:5])
        assert flow == moved
        for level in range(-5, 40):
            same = walked({**base, w: level})[0] == accepted
            assert same == (low <= level <= high), (w, level)


def test_create_purchase_orders(spark, make):
    ds = make(
        NOW,
        suppliers=[{"supplier_id": 1, "name": "S"}],
        warehouses=places(1),
        employees=STAFF,
        products=[{"product_id": p, "sku": str(p), "name": "x"} for p in (1, 2)],
        purchase_orders=[{"po_id": 40}],
        purchase_order_items=[{"po_item_id": 70, "po_id": 40}],
    )
    two = '[{"product_id": 1, "quantity": 10, "unit_cost": 12.505}, {"product_id": "2", "quantity": 1, "unit_cost": 3}]'
    commands = spark.createDataFrame(
        [
            (1, 1, 1, 1, two),
            (2, 1, 1, 1, "[]"),
            (3, 1, 1, 1, '[{"product_id": 1'),
            (4, 1, 1, 1, two.replace('"quantity": 1,', '"quantity": 0,')),
            (5, 1, 1, 1, '{"product_id": 1, "quantity": 1, "unit_cost": 1}'),
            (6, 9, 1, 1, two),
            (7, 1, 1, 1, '[{"product_id": 9, "quantity": 1, "unit_cost": 1}]'),
            (8, 1, 1, 1, '[{"product_id": 1, "quantity": 1.5, "unit_cost": 1}]'),
            (9, 1, 1, 1, '[{"product_id": 2, "quantity": 4}]'),
        ],
        "command_id long, supplier_id long, warehouse_id long, employee_id long, items string",
    )
    out = create_purchase_orders(ds, commands)
    orders = sorted(out.appended["purchase_orders"].collect(), key=lambda r: r.po_id)
    assert [(r.po_id, r.status, r.order_date, r.expected_delivery_date) for r in orders] == [
        (41, "pending", date(2024, 6, 1), date(2024, 6, 15)),
        (42, "pending", date(2024, 6, 1), date(2024, 6, 15)),
    ]
    lines = sorted(out.appended["purchase_order_items"].collect(), key=lambda r: r.po_item_id)
    assert [(r.po_item_id, r.po_id, r.product_id, r.quantity_ordered, r.quantity_received, r.unit_cost) for r in lines] == [
        (71, 41, 1, 10, 0, Decimal("12.51")),
        (72, 41, 2, 1, 0, Decimal("3.00")),
    ]
    assert {r.command_id for r in out.rejects.collect()} == {3, 4, 5, 6, 7, 8, 9}


def test_reserve_and_guard(spark, make):
    ds = make(
        NOW,
        inventory=stock((1, 1, 10, 2), (2, 1, 5, 0)),
        sales_orders=[{"so_id": 1, "warehouse_id": 1}, {"so_id": 2, "warehouse_id": 2}],
    )
    lines = spark.createDataFrame([(1, 1, 3), (1, 1, 20), (2, 1, 4)], "so_id long, product_id long, quantity int")
    after = as_dict(reserve_for_sales(ds, lines), ["product_id", "warehouse_id"], "quantity_reserved", "last_updated")
    assert after == {(1, 1): (25, NOW), (2, 1): (0, datetime(2024, 1, 1))}

    delta = "product_id long, warehouse_id long, delta int"
    bad = update_stock(ds, spark.createDataFrame([(1, 1, -11), (2, 1, -1)], delta))
    assert not bad.tables and [r.message for r in bad.rejects.collect()] == [
        "stock of product 1 at warehouse 1 would go negative"
    ]
    good = update_stock(ds, spark.createDataFrame([(1, 1, -11), (1, 1, 1)], delta))
    assert as_dict(good.tables["inventory"], ["product_id"], "quantity_on_hand") == {(1,): (0,), (2,): (5,)}

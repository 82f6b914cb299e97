"""Literal rows for what two engines could get wrong together: nulls, gaps, ties, edges, fan-out."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from stockyard.operators.ledger import derive_movements
from stockyard.plans import (
    benchmarks,
    cases,
    customer,
    hierarchies,
    inventory,
    kpi,
    matviews,
    sales,
    supplier,
    views,
    warehouse,
    windows,
)

NOON = datetime(2024, 6, 1, 12)
D = Decimal


def rows(df):
    return [tuple(r) for r in df.collect()]


def order(so, customer=1, day=date(2024, 5, 1), status="delivered", warehouse=1, employee=1, ship=None):
    return {
        "so_id": so, "customer_id": customer, "warehouse_id": warehouse, "employee_id": employee,
        "order_date": day, "ship_date": ship, "status": status,
    }


def line(item, so, product=1, quantity=1, price="10.00", discount="0"):
    return {
        "so_item_id": item, "so_id": so, "product_id": product, "quantity": quantity,
        "unit_price": D(price), "discount_pct": D(discount),
    }


def product(pid, name, price="10.00", cost="4.00", reorder=10, category=1):
    return {
        "product_id": pid, "name": name, "unit_price": D(price), "unit_cost": D(cost),
        "reorder_level": reorder, "category_id": category,
    }


def shelf(pid, wid, have, held=0):
    return {"product_id": pid, "warehouse_id": wid, "quantity_on_hand": have, "quantity_reserved": held}


def move(mid, pid, wid, kind, quantity, when):
    return {
        "movement_id": mid, "product_id": pid, "warehouse_id": wid, "movement_type": kind,
        "quantity": quantity, "movement_date": when,
    }


def place(wid, name, capacity=100):
    return {"warehouse_id": wid, "name": name, "capacity_units": capacity}


def test_growth_steps_over_rows_not_months(make):
    months = [date(2023, m, 1) for m in range(1, 13)] + [date(2024, 2, 1)]  # January 2024 is missing
    ds = make(
        NOON,
        sales_orders=[order(i, day=d) for i, d in enumerate(months)] + [order(90, status="cancelled")],
        sales_order_items=[line(i, i, quantity=i + 1) for i in range(13)] + [line(90, 90, quantity=99)],
    )
    yoy = rows(sales.revenue_yoy_growth(ds))
    assert yoy[12][0] == date(2024, 2, 1) and yoy[12][2] == D("1200.00")  # against January 2023
    assert all(r[2] is None for r in yoy[:12])
    assert rows(sales.revenue_mom_growth(ds))[1][2] == D("100.00")
    assert rows(sales.revenue_ytd(ds))[12][2] == D("130")
    assert rows(matviews.monthly_sales(ds).orderBy("month"))[0] == (date(2023, 1, 1), D("10"), 1)


def test_discount_is_exact(make):
    ds = make(NOON, sales_orders=[order(1)], sales_order_items=[line(1, 1, quantity=3, price="0.35", discount="12.50")])
    assert rows(sales.revenue_by_month(ds)) == [(date(2024, 5, 1), D("0.918750"))]
    assert rows(sales.discount_impact(ds)) == [(date(2024, 5, 1), D("0.131250"))]


def test_same_names_merge_and_ties_sort_by_name(make):
    ds = make(
        NOON,
        products=[product(1, "b"), product(2, "a"), product(3, "a")],
        sales_orders=[order(1), order(2, status="cancelled")],
        sales_order_items=[line(1, 1, 1, 5), line(2, 1, 2, 2), line(3, 1, 3, 3), line(4, 2, 1, 50)],
    )
    assert rows(sales.best_sellers(ds)) == [("a", 5), ("b", 5)]
    assert rows(sales.best_sellers(ds, limit=1)) == [("a", 5)]


def test_segments_without_name(make):
    ds = make(
        NOON,
        customers=[{"customer_id": 1, "name": "x", "segment": None}, {"customer_id": 2, "name": "x", "segment": "retail"}],
        sales_orders=[order(1, 1), order(2, 2), order(3, 2)],
        sales_order_items=[line(1, 1, quantity=1), line(2, 2, quantity=2), line(3, 3, quantity=5)],
    )
    assert rows(sales.aov_by_segment(ds)) == [("retail", D("35.00")), (None, D("10.00"))]
    assert {r[0]: r[2] for r in rows(customer.segment_revenue_share(ds))} == {"retail": D("87.50"), None: D("12.50")}
    assert rows(customer.customer_ltv_top(ds)) == [("x", D("80.000000"))]
    assert len(rows(views.customer_ltv(ds))) == 2


def test_windows_of_time_are_open_below(make):
    """Exactly 30 or 90 days back is outside; at noon, a date 30 days back is before the bound."""
    ds = make(
        NOON,
        products=[product(1, "p"), product(2, "q"), product(3, "never")],
        inventory=[shelf(1, 1, 5), shelf(2, 1, 5), shelf(2, 2, 0)],
        inventory_movements=[
            move(1, 1, 1, "outbound", -3, datetime(2024, 3, 3, 12)),  # exactly 90 days
            move(2, 2, 1, "outbound", -4, datetime(2024, 3, 3, 12, 0, 1)),
            move(3, 2, 2, "outbound", -6, datetime(2024, 5, 3)),
            move(4, 1, 1, "inbound", 9, datetime(2024, 7, 1)),
            move(5, 2, 1, "outbound", -1, datetime(2025, 1, 1)),  # no upper bound
        ],
    )
    assert rows(inventory.dead_stock(ds)) == [("p", 1, 5)]
    assert rows(inventory.fast_movers(ds)) == [("q", 7)]
    assert rows(inventory.slow_movers(ds)) == [("never", 0), ("p", 0), ("q", 11)]
    assert rows(inventory.inventory_aging(ds)) == [(2, 1, 5, None), (2, 2, 0, None), (1, 1, 5, -30)]
    assert rows(benchmarks.warehouse_movements_30d(ds, 2)) == [(2, 1)]
    assert rows(benchmarks.warehouse_movements_30d(ds, 9)) == []


def test_cover_threshold_is_not_rounded(make):
    ds = make(
        NOON,
        inventory=[shelf(1, 1, 7), shelf(2, 1, 7), shelf(3, 1, 0)],
        inventory_movements=[
            move(1, 1, 1, "outbound", -30, datetime(2024, 5, 30)),  # exactly 7 days
            move(2, 2, 1, "outbound", -31, datetime(2024, 5, 30)),
        ],
    )
    assert [(r[0], r[4]) for r in rows(inventory.stockout_risk(ds))] == [(2, D("6.8"))]


def test_reorder_and_utilization(make):
    ds = make(
        NOON,
        products=[product(1, "p", reorder=5)],
        warehouses=[place(1, "A"), place(2, "B"), place(3, "Empty")],
        inventory=[shelf(1, 1, 5, 4), shelf(1, 2, 4)],
    )
    assert rows(inventory.below_reorder(ds)) == [("p", 2, 4, 5)]
    status = {r.warehouse_id: (r.quantity_available, r.needs_reorder) for r in views.inventory_status(ds).collect()}
    assert status == {1: (1, False), 2: (4, True)}
    assert len(rows(warehouse.warehouse_utilization(ds))) == 2
    assert (3, "Empty", 100, 0, D("0.0")) in rows(views.warehouse_utilization(ds))


def purchase(po, sid, status="received", ordered=date(2024, 1, 1), expected=date(2024, 1, 10), actual=date(2024, 1, 10)):
    return {
        "po_id": po, "supplier_id": sid, "warehouse_id": 1, "status": status, "order_date": ordered,
        "expected_delivery_date": expected, "actual_delivery_date": actual,
    }


def test_suppliers(make):
    ds = make(
        NOON,
        suppliers=[
            {"supplier_id": 1, "name": "s", "country": None, "rating": D("4.0")},
            {"supplier_id": 2, "name": "s", "country": None, "rating": None},
            {"supplier_id": 3, "name": "t", "country": "x", "rating": D("2.0")},
            {"supplier_id": 4, "name": "u", "country": None, "rating": D("4.0")},
        ],
        purchase_orders=[
            purchase(1, 1, actual=date(2024, 1, 16)), purchase(2, 1, actual=date(2024, 1, 15)),
            purchase(3, 2), purchase(4, 3, actual=None), purchase(5, 4, "shipped"),
            purchase(6, 4, actual=date(2024, 1, 15)),
        ],
        purchase_order_items=[
            {"po_item_id": i, "po_id": i, "product_id": 1, "quantity_ordered": 9, "quantity_received": 2, "unit_cost": D("1.50")}
            for i in range(1, 7)
        ],
    )
    assert rows(supplier.supplier_lead_time(ds)) == [("s", D("12.7")), ("u", D("14.0")), ("t", None)]
    assert rows(supplier.supplier_late_rate(ds)) == []
    assert rows(supplier.supplier_late_rate(ds, min_deliveries=3)) == [("s", 2, 3, D("66.7"))]
    assert rows(supplier.supplier_spend_top(ds)) == [("s", D("9.00")), ("t", D("3.00")), ("u", D("3.00"))]
    assert sorted(rows(supplier.supplier_spend_rank(ds).select("name", "spend_rank"))) == [("s", 1), ("t", 2), ("u", 2)]
    assert rows(supplier.good_rating_slow_suppliers(ds)) == [("s", D("4.0"))]  # 14 days is not more than 14
    ranks = {(r.name, r.rating): r.rank_in_country for r in cases.supplier_rank_in_country(ds).collect()}
    assert ranks == {("s", None): 1, ("s", D("4.0")): 2, ("u", D("4.0")): 2, ("t", D("2.0")): 1}
    on_time = {r.supplier_id: r.on_time_pct for r in views.supplier_performance(ds).collect()}
    assert on_time == {1: D("0.0"), 2: D("100.0"), 3: D("0.0"), 4: D("0.0")}


def test_order_count_buckets(make):
    counts = {1: 0, 2: 1, 3: 3, 4: 4, 5: 10, 6: 11}
    ds = make(
        NOON,
        customers=[{"customer_id": c, "name": str(c)} for c in counts],
        sales_orders=[
            order(c * 100 + i, c, day=date(2023, 12, 1) if c == 2 else date(2023, 12, 2), status="cancelled")
            for c, n in counts.items()
            for i in range(n)
        ],
    )
    assert rows(customer.order_frequency(ds)) == [("0", 1), ("1-3", 2), ("10+", 1), ("4-10", 2)]
    # six months before 1 June noon is 1 December noon; cancelled orders count as activity
    assert [r[0] for r in rows(customer.churn_risk(ds))] == [1, 2]


def test_per_customer_windows(make):
    ds = make(
        NOON,
        sales_orders=[
            order(1, 1, date(2024, 1, 1)), order(3, 1, date(2024, 1, 5)), order(2, 1, date(2024, 1, 5)),
            order(4, 1, date(2024, 1, 9), status="cancelled"), order(5, 2, date(2024, 1, 1)),
        ],
    )
    latest = {r.customer_id: (r.so_id, r.rn) for r in windows.latest_order_per_customer(ds).collect()}
    assert latest == {1: (4, 1), 2: (5, 1)}
    gaps = sorted((r[0], r[1].day, r[2]) for r in rows(windows.order_gap(ds, limit=None)) if r[0] == 1)
    assert [g[:2] for g in gaps] == [(1, 1), (1, 5), (1, 5)] and sorted(g[2] for g in gaps[1:]) == [0, 4]
    assert gaps[0][2] is None
    assert sorted(rows(windows.order_gap(ds, limit=3)), key=str) == sorted(
        [r for r in rows(windows.order_gap(ds, limit=None)) if r[0] == 1], key=str
    )


def test_prices_quartiles_and_distribution(make):
    ds = make(
        NOON,
        products=[product(i, f"p{i}") for i in (1, 2, 3)],
        sales_orders=[order(i, day=date(2024, 1, i)) for i in (1, 2, 9)] + [order(4, status="cancelled")],
        sales_order_items=[
            line(11, 1, 1, 1, "5.00"), line(10, 2, 1, 1, "7.00"), line(12, 9, 2, 1, "5.00"), line(13, 4, 3, 1, "20.00"),
        ],
    )
    assert rows(windows.first_last_price(ds)) == [(1, D("7.00"), D("5.00")), (2, D("5.00"), D("5.00")), (3, D("20.00"), D("20.00"))]
    assert [r[0::2] for r in rows(windows.product_revenue_quartile(ds))] == [(3, 1), (1, 2), (2, 3)]
    dist = {r.so_id: (r.order_total, r.cume_dist) for r in windows.order_value_cume_dist(ds).collect()}
    assert dist == {1: (D("5.00"), D("0.500")), 9: (D("5.00"), D("0.500")), 2: (D("7.00"), D("0.750")), 4: (D("20.00"), D("1.000"))}
    assert rows(windows.rolling_7day_revenue(ds))[2] == (date(2024, 1, 9), D("5.00"), D("5.67"))


def test_kpis_of_nothing_and_division_by_zero(make):
    ds = make(NOON, products=[product(1, "free", price="0.00")])
    assert rows(kpi.kpi_snapshot(ds)) == [(None, 0, None, 0, None)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        kpi.gross_margin(ds).collect()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        kpi.fulfillment_rate(ds).collect()
    assert rows(kpi.inventory_turnover(ds)) == [(None,)]


def test_corrections_multiply_sales(make):
    ds = make(
        NOON,
        products=[product(1, "none"), product(2, "one"), product(3, "three"), product(4, "three")],
        sales_orders=[order(1)],
        sales_order_items=[line(i, 1, p, 5) for i, p in enumerate((1, 2, 2, 3, 3, 4))],
        inventory_movements=[move(i, p, 1, "adjustment", -1, NOON) for i, p in enumerate((2, 3, 3, 3))],
    )
    assert rows(cases.popular_understocked(ds)) == [("three", 35, 3), ("one", 10, 1)]
    assert rows(cases.popular_understocked(ds, dedupe=True)) == [("three", 15, 3), ("one", 10, 1)]


def test_anti_joins(make):
    ds = make(
        NOON,
        products=[product(1, "a"), product(2, "b"), product(3, "c"), product(4, "b")],
        customers=[{"customer_id": 1, "name": "w", "segment": "wholesale"}, {"customer_id": 2, "name": "r", "segment": "retail"}],
        sales_orders=[order(1, 1, status="cancelled"), order(2, 2)],
        sales_order_items=[line(1, 1, 1), line(2, 2, 2), line(3, 1, 4)],
    )
    assert rows(cases.never_bought_by_wholesale(ds)) == [("b",), ("c",)]


def staff(eid, wid, title, manager=None, name="N"):
    return {
        "employee_id": eid, "warehouse_id": wid, "manager_id": manager, "first_name": name, "last_name": str(eid),
        "job_title": title,
    }


def test_pairs_with_and_without_limit_agree(make):
    people = [staff(i, i % 3, f"t{i % 2}") for i in range(1, 13)] + [staff(20, 1, "alone"), staff(21, 1, "alone")]
    ds = make(NOON, employees=people)
    every = [
        (f"N {a['employee_id']}", f"N {b['employee_id']}", a["job_title"])
        for a in people
        for b in people
        if a["job_title"] == b["job_title"] and a["warehouse_id"] != b["warehouse_id"] and a["employee_id"] < b["employee_id"]
    ]
    assert sorted(rows(cases.same_title_pairs(ds, limit=None))) == sorted(every)
    assert rows(cases.same_title_pairs(ds, limit=5)) == every[:5]


def test_trees_and_calendar(make, spark):
    ds = make(
        NOON,
        employees=[staff(1, 1, "t"), staff(2, 1, "t", 1), staff(3, 1, "t", 2), staff(4, 1, "t", 3), staff(5, 1, "t"), staff(6, 1, "t", 77)],
        product_categories=[
            {"category_id": 1, "name": "a", "parent_category_id": None},
            {"category_id": 2, "name": "b", "parent_category_id": 1},
        ],
    )
    assert [(r.employee_id, r.depth) for r in hierarchies.org_chart(ds).collect()] == [(1, 1), (5, 1), (2, 2), (3, 3), (4, 4)]
    assert rows(hierarchies.category_tree(ds))[1] == (2, "b", 1, "a > b", 2)
    calendar = rows(hierarchies.date_dimension(spark))
    assert len(calendar) == 30 and calendar[0] == (date(2023, 1, 1), 0, 1, 1, 2023, True)
    assert hierarchies.date_dimension(spark, limit=None).count() == 1461


def test_movement_chain_keeps_duplicates(make):
    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    moves = [
        move(1, 1, 1, "inbound", 5, days[0]), move(2, 1, 1, "inbound", 5, days[0]), move(3, 1, 1, "outbound", -1, days[1]),
        move(4, 1, 1, "outbound", -1, days[2]), move(5, 1, 2, "outbound", -1, days[2]),
    ]
    ds = make(NOON, inventory_movements=moves)
    want = [(1, 1), (2, 1), (3, 2), (3, 2), (4, 2), (4, 2), (4, 3), (4, 3)]
    for limit in (None, 100):
        assert [(r.movement_id, r.step) for r in hierarchies.movement_chain(ds, limit).collect()] == want
    assert [(r.movement_id, r.step) for r in hierarchies.movement_chain(ds, 3).collect()] == want[:3]


def test_ledger_rules(make):
    day = date(2024, 1, 5)
    item = {"product_id": 1, "quantity_ordered": 5, "unit_cost": D("1")}
    transfer = {"product_id": 1, "from_warehouse_id": 1, "to_warehouse_id": 2, "quantity": 4, "transfer_date": day}
    ds = make(
        NOON,
        purchase_orders=[purchase(1, 1, actual=day), purchase(2, 1, "shipped", actual=None)],
        purchase_order_items=[
            {"po_item_id": 1, "po_id": 1, "quantity_received": 5, **item},
            {"po_item_id": 2, "po_id": 1, "quantity_received": 0, **item},
            {"po_item_id": 3, "po_id": 2, "quantity_received": 3, **item},
        ],
        sales_orders=[order(s, status=t, ship=day) for s, t in enumerate(("pending", "shipped", "delivered", "cancelled"))],
        sales_order_items=[line(i, i, quantity=2) for i in range(4)],
        stock_transfers=[{"transfer_id": 1, "status": "completed", **transfer}, {"transfer_id": 2, "status": "pending", **transfer}],
    )
    got = sorted((r.movement_type, r.reference_id, r.warehouse_id, r.quantity) for r in derive_movements(ds).collect())
    assert got == [
        ("inbound", 1, 1, 5), ("outbound", 1, 1, -2), ("outbound", 2, 1, -2),
        ("transfer_in", 1, 2, 4), ("transfer_out", 1, 1, -4),
    ]
    assert len({r.movement_id for r in derive_movements(ds).collect()}) == 5


def test_full_but_slow(make):
    ds = make(
        NOON,
        warehouses=[place(1, "full", 100), place(2, "edge", 100), place(3, "fast", 100)],
        inventory=[shelf(1, 1, 91), shelf(1, 2, 90), shelf(1, 3, 99)],
        sales_orders=[order(1, warehouse=1), order(2, warehouse=2), *[order(i, warehouse=3) for i in range(3, 9)]],
    )
    assert rows(cases.full_and_slow_warehouses(ds)) == [("full", 91.0, 1.0)]

"""One violating row per rule, and what must not count as a violation."""

from datetime import date, datetime
from decimal import Decimal

from stockyard.operators.quality import delete_with_lines, validate, with_defaults
from stockyard.sources.tpch import load_tpch

T0 = datetime(2024, 1, 1)


def test_rules(make):
    order = {"customer_id": 1, "warehouse_id": 1, "employee_id": 1, "order_date": date(2024, 1, 1), "created_at": T0}
    customer = {"name": "n", "created_at": T0}
    ds = make(
        warehouses=[{"warehouse_id": 1, "name": "W" * 101, "city": "c", "country": "x", "capacity_units": 0, "created_at": T0}],
        suppliers=[
            {"supplier_id": 1, "name": "a", "created_at": T0, "rating": Decimal("5.1")},
            {"supplier_id": 2, "name": "b", "created_at": T0},
        ],
        customers=[
            {"customer_id": 1, "email": None, "segment": None, **customer},
            {"customer_id": 2, "email": None, "segment": "vip", **customer},
            {"customer_id": 3, "email": "e", **customer},
            {"customer_id": 3, "email": "e", **customer},
        ],
        sales_orders=[
            {"so_id": 1, "status": "lost", **order},
            {"so_id": 2, "status": None, **order, "customer_id": 77},
        ],
        employees=[
            {"employee_id": 1, "warehouse_id": 1, "manager_id": 9, "first_name": "a", "last_name": "b", "email": "x",
             "job_title": "t", "hire_date": date(2024, 1, 1), "created_at": T0}
        ],
        inventory=[
            {"inventory_id": i, "product_id": 5, "warehouse_id": 1, "quantity_on_hand": -i, "quantity_reserved": -1,
             "last_updated": T0}
            for i in (1, 2, 3)
        ],
        stock_transfers=[
            {"transfer_id": 1, "product_id": 5, "from_warehouse_id": 1, "to_warehouse_id": 1, "employee_id": 1,
             "quantity": 0, "transfer_date": date(2024, 1, 1), "status": "completed"}
        ],
        sales_order_items=[
            {"so_item_id": 1, "so_id": 1, "product_id": 5, "quantity": 0, "unit_price": Decimal(1), "discount_pct": Decimal("-1")}
        ],
        purchase_order_items=[
            {"po_item_id": 1, "po_id": 8, "product_id": 5, "quantity_ordered": 0, "quantity_received": -1, "unit_cost": Decimal(1)}
        ],
        products=[
            {"product_id": 1, "sku": "s", "name": "n", "category_id": 1, "supplier_id": 1, "unit_price": Decimal(-1),
             "unit_cost": Decimal(-1), "reorder_level": 1, "reorder_qty": 1, "created_at": T0}
        ],
        inventory_movements=[
            {"movement_id": 1, "product_id": 1, "warehouse_id": 1, "movement_type": "lost", "quantity": 1, "movement_date": T0}
        ],
        purchase_orders=[
            {"po_id": 1, "supplier_id": 1, "warehouse_id": 1, "employee_id": 1, "order_date": date(2024, 1, 1),
             "status": "delivered", "created_at": T0}
        ],
    )
    found = {(r.table, r.rule): r.violations for r in validate(ds).collect() if r.violations}
    assert found == {
        ("warehouses", "name_length"): 1,
        ("warehouses", "capacity_units_positive"): 1,
        ("suppliers", "rating_0_to_5"): 1,
        ("customers", "segment_known"): 1,
        ("customers", "customer_id_unique"): 1,
        ("customers", "email_unique"): 1,
        ("sales_orders", "status_known"): 1,
        ("sales_orders", "status_not_null"): 1,
        ("sales_orders", "customer_id_exists"): 1,
        ("employees", "manager_id_exists"): 1,
        ("inventory", "product_id_warehouse_id_unique"): 2,
        ("inventory", "on_hand_not_negative"): 3,
        ("inventory", "reserved_not_negative"): 3,
        ("inventory", "product_id_exists"): 3,
        ("stock_transfers", "two_warehouses"): 1,
        ("stock_transfers", "quantity_positive"): 1,
        ("stock_transfers", "product_id_exists"): 1,
        ("sales_order_items", "quantity_positive"): 1,
        ("sales_order_items", "discount_0_to_100"): 1,
        ("sales_order_items", "product_id_exists"): 1,
        ("purchase_order_items", "quantity_ordered_positive"): 1,
        ("purchase_order_items", "quantity_received_not_negative"): 1,
        ("purchase_order_items", "po_id_exists"): 1,
        ("purchase_order_items", "product_id_exists"): 1,
        ("products", "unit_price_not_negative"): 1,
        ("products", "unit_cost_not_negative"): 1,
        ("products", "category_id_exists"): 1,
        ("inventory_movements", "movement_type_known"): 1,
        ("purchase_orders", "status_known"): 1,
    }


def test_supplied_tables_are_clean(spark):
    ds = load_tpch(spark, "/root/testdata/sf0.001")
    report = validate(ds).collect()
    assert len(report) > 130 and not [r for r in report if r.violations]


def test_delete_takes_lines_along(make):
    ds = make(
        sales_orders=[{"so_id": 1}, {"so_id": 2}],
        sales_order_items=[{"so_item_id": 1, "so_id": 1}, {"so_item_id": 2, "so_id": 2}],
    )
    left = delete_with_lines(ds, "sales_orders", ds.sales_orders.filter("so_id = 1"))
    assert [r.so_id for r in left.sales_orders.collect()] == [2]
    assert [r.so_item_id for r in left.sales_order_items.collect()] == [2]


def test_defaults_fill_only_absent_columns(spark, make):
    ds = make(T0)
    rows = spark.sql("select 1L as po_id, 2L as supplier_id, cast(null as string) as status")
    row = with_defaults("purchase_orders", rows, ds).first()
    assert row.status is None and row.created_at == T0 and row.warehouse_id is None

"""The thirteen-table mapping (FIXTURES.md) once more, as named DuckDB subqueries."""

from __future__ import annotations

import re

PARTS = "(SELECT count(*) FROM part)"
SUPPLIERS = "(SELECT count(*) FROM supplier)"
PEOPLE = "(SELECT count(*) FROM customer)"

FOUNDED = "TIMESTAMP '1995-01-01' AS created_at"
_ROOT = "(ascii(p_type) * 100 + ascii(substr(p_type, 2)))::BIGINT"
_CHILD = f"({_ROOT} * 1000 + substr(p_brand, 7)::BIGINT)"

TABLE_SQL: dict[str, str] = {
    "warehouses": f"""
        SELECT (n_nationkey + 1)::BIGINT AS warehouse_id, 'Warehouse ' || n_name AS name, NULL::VARCHAR AS address, n_name AS city, NULL::VARCHAR AS state,
               r_name AS country, ({PARTS} * (140 + 10 * (n_nationkey % 5)))::BIGINT AS capacity_units, {FOUNDED}
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "employees": f"""
        SELECT c_custkey + 1 AS employee_id, (c_nationkey + 1)::BIGINT AS warehouse_id,
               CASE WHEN c_custkey >= 3 THEN (c_custkey - 1) // 3 + 1 END AS manager_id,
               'First' || (c_custkey % 20) AS first_name, 'Last' || (c_custkey % 7) AS last_name,
               'e' || c_custkey || '@staff.example' AS email, NULL::VARCHAR AS phone,
               CASE WHEN c_custkey < 3 THEN 'Site Head' ELSE
                 (['Stock Keeper', 'Truck Loader', 'Dock Planner', 'Goods Inspector', 'Route Analyst', 'Floor Lead',
                   'Order Packer'])[(c_custkey % 7 + 1)::INT]
               END AS job_title, DATE '1990-01-01' + (c_custkey % 1800)::INT AS hire_date, {FOUNDED}
        FROM customer""",
    "product_categories": f"""
        SELECT DISTINCT {_ROOT} AS category_id, p_type AS name, NULL::BIGINT AS parent_category_id FROM part
        UNION ALL
        SELECT DISTINCT {_CHILD}, p_type || ' ' || p_brand, {_ROOT} FROM part""",
    "suppliers": f"""
        SELECT s_suppkey + 1 AS supplier_id, s_name AS name, NULL::VARCHAR AS contact_name, NULL::VARCHAR AS email,
               NULL::VARCHAR AS phone, n_name AS country,
               CASE WHEN s_suppkey % 10 != 9 THEN ((20 + s_suppkey * 7 % 31) * 0.1)::DECIMAL(2,1) END AS rating, {FOUNDED}
        FROM supplier, nation WHERE s_nationkey = n_nationkey""",
    "products": f"""
        SELECT p_partkey + 1 AS product_id, 'SKU' || p_partkey AS sku, p_name || ' ' || p_brand AS name, {_CHILD} AS category_id,
               p_partkey % {SUPPLIERS} + 1 AS supplier_id, p_retailprice::DECIMAL(10,2) AS unit_price,
               (p_retailprice::DECIMAL(10,2) - (100 + p_partkey % 400))::DECIMAL(10,2) AS unit_cost,
               5 + p_size % 46 AS reorder_level, 50 + p_partkey % 151 AS reorder_qty, {FOUNDED}
        FROM part""",
    "customers": f"""
        SELECT c_custkey + 1 AS customer_id, c_name AS name, 'c' || c_custkey || '@mail.example' AS email,
               NULL::VARCHAR AS phone, NULL::VARCHAR AS address, NULL::VARCHAR AS city, n_name AS country,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'retail'
                    WHEN c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0 THEN 'wholesale'
                    WHEN c_mktsegment = 'MACHINERY' THEN 'enterprise' ELSE 'online' END AS segment, {FOUNDED}
        FROM customer, nation WHERE c_nationkey = n_nationkey""",
    "sales_orders": f"""
        SELECT o_orderkey + 1 AS so_id,
               o_custkey + CASE WHEN o_custkey % 50 = 0 THEN 2 ELSE 1 END AS customer_id,
               o_custkey % 25 + 1 AS warehouse_id, (o_custkey + o_orderkey) % {PEOPLE} + 1 AS employee_id,
               o_orderdate::DATE AS order_date,
               CASE WHEN o_orderkey % 20 > 1 THEN o_orderdate::DATE + (o_orderkey % 5 + 1)::INT END AS ship_date,
               CASE o_orderkey % 20 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'pending' WHEN 2 THEN 'shipped'
                    WHEN 3 THEN 'shipped' ELSE 'delivered' END AS status,
               o_orderdate AS created_at
        FROM orders""",
    # Ids told apart by counting: a line's place among its order's lines of the same remainder.
    "line_parts": """
        SELECT *, (l_partkey + l_suppkey + l_linenumber + l_quantity::BIGINT) % parts AS remainder
        FROM lineitem, (SELECT greatest(64, max(n) // 65536 + 1) AS parts
                        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey))""",
    "line_room": "SELECT max(n) AS room FROM (SELECT count(*) AS n FROM line_parts GROUP BY l_orderkey, remainder)",
    "tpch_lines": """
        SELECT (l_orderkey * parts + remainder) * room + place - min(place) OVER (PARTITION BY l_orderkey, remainder) AS line_id,
               l_orderkey, l_orderkey + 1 AS order_id, l_partkey + 1 AS product_id, l_quantity::INT AS quantity,
               round(l_extendedprice * 100)::BIGINT // l_quantity::BIGINT AS cents, l_discount
        FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, remainder, l_linenumber, l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place FROM line_parts), line_room""",
    "sales_order_items": """
        SELECT line_id AS so_item_id, order_id AS so_id, product_id, quantity,
               (cents * 0.01)::DECIMAL(10,2) AS unit_price, round(l_discount * 100)::DECIMAL(4,2) AS discount_pct
        FROM tpch_lines""",
    "purchase_orders": f"""
        SELECT o_orderkey + 1 AS po_id, o_orderkey % {SUPPLIERS} + 1 AS supplier_id,
               o_custkey % 25 + 1 AS warehouse_id, o_orderkey * 3 % {PEOPLE} + 1 AS employee_id,
               o_orderdate::DATE AS order_date,
               o_orderdate::DATE + (5 + o_custkey % 17)::INT AS expected_delivery_date,
               CASE WHEN o_orderkey % 20 > 3 THEN
                 o_orderdate::DATE + (3 + o_custkey % 17 + (o_custkey + o_orderkey) % 13)::INT
               END AS actual_delivery_date,
               CASE o_orderkey % 20 WHEN 0 THEN 'pending' WHEN 1 THEN 'shipped' WHEN 2 THEN 'shipped'
                    WHEN 3 THEN 'cancelled' ELSE 'received' END AS status,
               o_orderdate AS created_at
        FROM orders""",
    "purchase_order_items": """
        SELECT line_id AS po_item_id, order_id AS po_id, product_id, quantity * 10 AS quantity_ordered,
               quantity * CASE l_orderkey % 20 WHEN 0 THEN 0 WHEN 3 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 5 ELSE 10 END
                 AS quantity_received,
               ((cents * 6 // 10) * 0.01)::DECIMAL(10,2) AS unit_cost
        FROM tpch_lines""",
    "inventory": """
        SELECT p_partkey * 25 + n + 1 AS inventory_id, p_partkey + 1 AS product_id, n + 1 AS warehouse_id, on_hand::INT AS quantity_on_hand,
               (on_hand % 200)::INT AS quantity_reserved, TIMESTAMP '2001-08-01' AS last_updated
        FROM (SELECT p_partkey, n, (p_partkey * 37 + n * 101) % CASE WHEN (p_partkey + n) % 4 = 0 THEN 8 ELSE 2001 END
                       AS on_hand
              FROM (SELECT p_partkey, p_partkey % 5 + 5 * unnest([0, 1, 2, 3, 4]) AS n FROM part))""",
    "stock_transfers": f"""
        SELECT o_orderkey + 1 AS transfer_id, o_orderkey % {PARTS} + 1 AS product_id,
               o_custkey % 25 + 1 AS from_warehouse_id, (o_custkey + 1 + o_custkey % 23) % 25 + 1 AS to_warehouse_id,
               o_orderkey * 11 % {PEOPLE} + 1 AS employee_id, (10 + o_orderkey % 291)::INT AS quantity,
               o_orderdate::DATE AS transfer_date,
               CASE o_custkey % 10 WHEN 8 THEN 'in_transit' WHEN 9 THEN 'cancelled' ELSE 'completed' END AS status
        FROM orders""",
    "inventory_movements": f"""
        SELECT l.po_item_id * 10 + 1 AS movement_id, l.product_id, o.warehouse_id, 'inbound' AS movement_type,
               l.quantity_received AS quantity, l.po_item_id AS reference_id, 'purchase_order' AS reference_type,
               o.actual_delivery_date::TIMESTAMP AS movement_date
        FROM purchase_order_items l, purchase_orders o
        WHERE o.po_id = l.po_id AND l.quantity_received > 0 AND o.status = 'received'
        UNION ALL
        SELECT l.so_item_id * 10 + 2, l.product_id, o.warehouse_id, 'outbound', -l.quantity, l.so_item_id,
               'sales_order', o.ship_date::TIMESTAMP
        FROM sales_order_items l, sales_orders o
        WHERE o.so_id = l.so_id AND o.status IN ('delivered', 'shipped')
        UNION ALL
        SELECT transfer_id * 10 + leg.code, product_id, leg.warehouse_id, leg.kind, leg.units, transfer_id,
               'transfer', transfer_date::TIMESTAMP
        FROM (SELECT *, unnest([{{'code': 4, 'kind': 'transfer_out', 'warehouse_id': from_warehouse_id, 'units': -quantity}},
                                {{'code': 3, 'kind': 'transfer_in', 'warehouse_id': to_warehouse_id, 'units': quantity}}])
                AS leg
              FROM stock_transfers WHERE status = 'completed')
        UNION ALL
        SELECT event_id * 10 + 5, event_id % {PARTS} + 1, user_id % 25 + 1, 'adjustment', -(event_id % 5 + 1)::INT,
               event_id, 'adjustment', ts - INTERVAL 23 YEAR
        FROM events WHERE event_type = 'error'""",
    # Building blocks several checks share.
    "sale": """
        SELECT h.so_id, h.customer_id, h.warehouse_id, h.employee_id, h.order_date, h.status, l.product_id,
               l.quantity, l.quantity * l.unit_price AS gross, l.quantity * l.unit_price * l.discount_pct * 0.01 AS saved,
               l.quantity * l.unit_price * (100 - l.discount_pct) * 0.01 AS net
        FROM sales_order_items l INNER JOIN sales_orders h USING (so_id)""",
    "live_sale": "SELECT * FROM sale WHERE status <> 'cancelled'",
    "monthly": """
        SELECT date_trunc('month', order_date)::DATE AS month, sum(net) AS revenue, sum(saved) AS saved,
               count(DISTINCT so_id) AS order_count
        FROM live_sale GROUP BY ALL""",
    "order_value": """
        SELECT so_id, customer_id, warehouse_id, employee_id, order_date, status, sum(net) AS order_total,
               sum(gross) AS gross_total
        FROM sale GROUP BY ALL""",
    "delivery": """
        SELECT supplier_id, actual_delivery_date - order_date AS days,
               actual_delivery_date > expected_delivery_date AS late
        FROM purchase_orders WHERE status = 'received'""",
    "spend": """
        SELECT h.supplier_id, sum(l.quantity_received * l.unit_cost) AS total_spend
        FROM purchase_orders h INNER JOIN purchase_order_items l USING (po_id)
        WHERE h.status = 'received' GROUP BY h.supplier_id""",
    "stocked": """
        SELECT i.*, p.name AS product_name, p.reorder_level, w.name AS warehouse_name, w.capacity_units,
               i.quantity_on_hand * p.unit_cost AS stock_value
        FROM inventory i INNER JOIN products p USING (product_id) INNER JOIN warehouses w USING (warehouse_id)""",
    "recent_out": """
        SELECT product_id, warehouse_id, sum(-quantity) FILTER (movement_date > TIMESTAMP '2001-08-02' - INTERVAL 30 DAY)
                 AS month_units, sum(-quantity) AS quarter_units
        FROM inventory_movements
        WHERE movement_type = 'outbound' AND movement_date > TIMESTAMP '2001-08-02' - INTERVAL 90 DAY
        GROUP BY ALL""",
}


def with_tables(body: str, **local: str) -> str:
    """``body`` preceded by the subqueries it needs; ``local`` adds or overrides some."""
    known = {**TABLE_SQL, **local}
    ordered: list[str] = []

    def need(text: str, seen: tuple[str, ...] = ()) -> None:
        for name in known:
            if name in ordered or name in seen:
                continue
            if re.search(rf"\b{name}\b", text):
                need(known[name], (*seen, name))
                if name not in ordered:
                    ordered.append(name)

    need(body)
    clauses = ",\n".join(f"{name} AS ({known[name].strip()})" for name in ordered)
    return f"WITH {clauses}\n{body.strip()}" if ordered else body.strip()


_TYPES = {"d": "DATE", "f": "DOUBLE", "i": "BIGINT", "s": "VARCHAR", "t": "TIMESTAMP", "b": "BOOLEAN"}


def typed(columns: str, body: str, **local: str) -> str:
    """Check query with its output columns cast, for example ``typed("name:s units:i", "SELECT …")``."""
    casts = []
    for item in columns.split():
        name, kind = item.split(":")
        casts.append(f"CAST(answer.{name} AS {_TYPES[kind]}) AS {name}")
    return with_tables(f"SELECT {', '.join(casts)} FROM ({body.strip()}) AS answer", **local)


def quotient(part: str, whole: str, digits: int, times: int = 1) -> str:
    """Half away from zero: the whole part of the quotient, one more if twice the remainder reaches the divisor."""
    over = f"(CAST(CAST({part} AS DECIMAL(28, 6)) * CAST(1000000 AS DECIMAL(7, 0)) AS HUGEINT) * {times * 10**digits})"
    under = f"CAST(CAST({whole} AS DECIMAL(28, 6)) * CAST(1000000 AS DECIMAL(7, 0)) AS HUGEINT)"
    up = f"(CASE WHEN 2 * abs({over} % {under}) >= abs({under}) THEN sign({over}) * sign({under}) ELSE 0 END)"
    return f"(CAST({over} // {under} + {up} AS DOUBLE) / {10**digits})"


def percent(part: str, whole: str, digits: int) -> str:
    return quotient(part, f"nullif({whole}, 0)", digits, 100)


def mean(total: str, count: str, digits: int) -> str:
    return quotient(total, count, digits)

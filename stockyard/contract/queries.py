"""Named queries over the supplied tables, each with the DuckDB text it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.contract.fixture_sql import mean, percent, quotient, typed
from stockyard.dataset import Dataset
from stockyard.operators import ledger
from stockyard.plans import cases, customer, hierarchies, inventory, kpi, sales, supplier, views, warehouse, windows
from stockyard.session import require_conf
from stockyard.sources.tpch import load_tpch


@dataclass(frozen=True)
class Entry:
    plan: Callable[[Dataset], DataFrame]
    check: str | None = None


def plain_types(df: DataFrame) -> DataFrame:
    """Output types both engines share: whole numbers as bigint, exact decimals as double."""
    casts = {
        item.name: F.col(item.name).cast("double" if isinstance(item.dataType, T.DecimalType) else "bigint")
        for item in df.schema.fields
        if isinstance(item.dataType, (T.DecimalType, T.IntegerType, T.ShortType, T.ByteType))
    }
    return df.withColumns(casts) if casts else df


@lru_cache(maxsize=1)
def _dataset(application: str, sf_dir: str) -> Dataset:
    """Tables are lazy plans; queries of one session share them."""
    return load_tpch(SparkSession.active(), sf_dir)


def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        require_conf(spark)
        return plain_types(entry.plan(_dataset(spark.sparkContext.applicationId, sf_dir)))

    return run


NOW = "TIMESTAMP '2001-08-02'"

SALES = {
    "q01_revenue_by_month": Entry(sales.revenue_by_month, typed("month:d revenue:f", "SELECT month, revenue FROM monthly")),
    "q02_revenue_mom_growth": Entry(
        sales.revenue_mom_growth,
        typed(
            "month:d revenue:f mom_growth_pct:f",
            f"""SELECT month, revenue, {percent("revenue - prior", "prior", 2)} AS mom_growth_pct
                FROM (SELECT *, lag(revenue) OVER (ORDER BY month) AS prior FROM monthly)""",
        ),
    ),
    "q03_revenue_yoy_growth": Entry(
        sales.revenue_yoy_growth,
        typed(
            "month:d revenue:f yoy_growth_pct:f",
            f"""SELECT month, revenue, {percent("revenue - prior", "prior", 2)} AS yoy_growth_pct
                FROM (SELECT *, lag(revenue, 12) OVER (ORDER BY month) AS prior FROM monthly)""",
        ),
    ),
    "q04_revenue_ytd": Entry(
        sales.revenue_ytd,
        typed(
            "month:d revenue:f ytd_running_total:f",
            """SELECT a.month, a.revenue, sum(b.revenue) AS ytd_running_total
               FROM monthly a, monthly b
               WHERE b.month <= a.month AND year(a.month) = year(b.month) GROUP BY a.month, a.revenue""",
        ),
    ),
    "q05_revenue_by_category": Entry(
        sales.revenue_by_category,
        typed(
            "category:s revenue:f",
            """SELECT k.name AS category, sum(s.net) AS revenue
               FROM live_sale s, products p, product_categories k
               WHERE p.product_id = s.product_id AND k.category_id = p.category_id GROUP BY k.name""",
        ),
    ),
    "q06_aov_by_segment": Entry(
        sales.aov_by_segment,
        typed(
            "segment:s avg_order_value:f",
            f"""SELECT segment, {mean("sum(order_total)", "count(*)", 2)} AS avg_order_value
                FROM order_value INNER JOIN customers USING (customer_id)
                WHERE status <> 'cancelled' GROUP BY segment""",
        ),
    ),
    "q07_best_sellers": Entry(
        sales.best_sellers,
        typed(
            "name:s units_sold:i",
            """SELECT name, sum(quantity) AS units_sold FROM live_sale INNER JOIN products USING (product_id)
               GROUP BY name ORDER BY units_sold DESC, name LIMIT 20""",
        ),
    ),
    "q08_discount_impact": Entry(
        sales.discount_impact, typed("month:d discount_value:f", "SELECT month, saved AS discount_value FROM monthly")
    ),
}

INVENTORY = {
    "q09_stock_by_warehouse": Entry(
        inventory.stock_by_warehouse,
        typed(
            "warehouse:s total_units:i",
            "SELECT warehouse_name AS warehouse, sum(quantity_on_hand) AS total_units FROM stocked GROUP BY 1",
        ),
    ),
    "q10_dead_stock": Entry(
        lambda ds: inventory.dead_stock(ds, limit=None),
        typed(
            "name:s warehouse_id:i quantity_on_hand:i",
            """SELECT s.product_name AS name, s.warehouse_id, s.quantity_on_hand
               FROM stocked s LEFT JOIN recent_out r USING (product_id, warehouse_id)
               WHERE s.quantity_on_hand > 0 AND r.product_id IS NULL""",
        ),
    ),
    "q11_fast_movers": Entry(
        inventory.fast_movers,
        typed(
            "name:s units_moved:i",
            """SELECT name, sum(month_units) AS units_moved FROM recent_out INNER JOIN products USING (product_id)
               WHERE month_units IS NOT NULL GROUP BY name ORDER BY units_moved DESC, name LIMIT 20""",
        ),
    ),
    "q12_slow_movers": Entry(
        inventory.slow_movers,
        typed(
            "name:s units_moved:i",
            """SELECT name, coalesce(sum(quarter_units), 0) AS units_moved
               FROM products LEFT JOIN recent_out USING (product_id)
               GROUP BY name ORDER BY units_moved, name LIMIT 20""",
        ),
    ),
}

_AGING = """SELECT i.product_id, i.warehouse_id, i.quantity_on_hand,
                   (SELECT DATE '2001-08-02' - max(m.movement_date)::DATE FROM inventory_movements m
                    WHERE m.movement_type = 'inbound' AND m.product_id = i.product_id
                      AND m.warehouse_id = i.warehouse_id) AS days_since_last_inbound
            FROM inventory i"""
_AGING_COLUMNS = "product_id:i warehouse_id:i quantity_on_hand:i days_since_last_inbound:i"
_RISK = f"""SELECT i.product_id, i.warehouse_id, i.quantity_on_hand,
                   CAST(r.month_units AS DOUBLE) / 30 AS daily_avg_out,
                   {mean("i.quantity_on_hand * 30", "r.month_units", 1)} AS days_of_cover
            FROM inventory i INNER JOIN recent_out r USING (product_id, warehouse_id)
            WHERE r.month_units > 0 AND i.quantity_on_hand * 30 < 7 * r.month_units"""
_RISK_COLUMNS = "product_id:i warehouse_id:i quantity_on_hand:i daily_avg_out:f days_of_cover:f"

INVENTORY |= {
    "q13_inventory_aging": Entry(
        inventory.inventory_aging,
        typed(
            _AGING_COLUMNS,
            f"{_AGING} ORDER BY days_since_last_inbound DESC NULLS FIRST, i.product_id, i.warehouse_id LIMIT 50",
        ),
    ),
    "q13_inventory_aging_all": Entry(
        lambda ds: inventory.inventory_aging(ds, limit=None), typed(_AGING_COLUMNS, _AGING)
    ),
    "q14_below_reorder": Entry(
        lambda ds: inventory.below_reorder(ds, limit=None),
        typed(
            "name:s warehouse_id:i quantity_on_hand:i reorder_level:i",
            """SELECT product_name AS name, warehouse_id, quantity_on_hand, reorder_level
               FROM stocked WHERE reorder_level > quantity_on_hand""",
        ),
    ),
    "q15_inventory_value_by_warehouse": Entry(
        inventory.inventory_value,
        typed(
            "name:s inventory_value:f",
            "SELECT warehouse_name AS name, sum(stock_value) AS inventory_value FROM stocked GROUP BY 1",
        ),
    ),
    "q16_stockout_risk": Entry(
        inventory.stockout_risk,
        typed(_RISK_COLUMNS, f"{_RISK} ORDER BY days_of_cover, i.product_id, i.warehouse_id LIMIT 50"),
    ),
    "q16_stockout_risk_all": Entry(
        lambda ds: inventory.stockout_risk(ds, limit=None), typed(_RISK_COLUMNS, _RISK)
    ),
}

WAREHOUSE = {
    "q17_warehouse_utilization": Entry(
        warehouse.warehouse_utilization,
        typed(
            "name:s capacity_units:i units_stored:i utilization_pct:f",
            f"""SELECT warehouse_name AS name, capacity_units, sum(quantity_on_hand) AS units_stored,
                       {percent("sum(quantity_on_hand)", "capacity_units", 1)} AS utilization_pct
                FROM stocked GROUP BY warehouse_id, warehouse_name, capacity_units""",
        ),
    ),
    "q18_transfer_volume": Entry(
        warehouse.transfer_volume,
        typed(
            "from_warehouse:s to_warehouse:s transfer_count:i units_transferred:i",
            """SELECT a.name AS from_warehouse, b.name AS to_warehouse, count(*) AS transfer_count,
                      sum(t.quantity) AS units_transferred
               FROM stock_transfers t, warehouses a, warehouses b
               WHERE a.warehouse_id = t.from_warehouse_id AND b.warehouse_id = t.to_warehouse_id
                 AND t.status = 'completed'
               GROUP BY a.name, b.name""",
        ),
    ),
    "q19_employee_orders": Entry(
        warehouse.employee_orders,
        typed(
            "employee:s warehouse:s orders_handled:i",
            """SELECT concat(e.first_name, ' ', e.last_name) AS employee, w.name AS warehouse,
                      count(*) AS orders_handled
               FROM sales_orders o, employees e, warehouses w
               WHERE o.employee_id = e.employee_id AND o.warehouse_id = w.warehouse_id AND o.status <> 'cancelled'
               GROUP BY ALL ORDER BY orders_handled DESC, employee, warehouse LIMIT 20""",
        ),
    ),
    "q20_warehouse_revenue_share": Entry(
        warehouse.warehouse_revenue_share,
        typed(
            "name:s revenue:f pct_of_total:f",
            f"""SELECT w.name, sum(s.net) AS revenue,
                       {percent("sum(s.net)", "(SELECT sum(net) FROM live_sale)", 2)} AS pct_of_total
                FROM live_sale s INNER JOIN warehouses w USING (warehouse_id) GROUP BY w.name""",
        ),
    ),
}

SUPPLIER = {
    "q21_supplier_lead_time": Entry(
        supplier.supplier_lead_time,
        typed(
            "name:s avg_lead_time_days:f",
            f"""SELECT name, {mean("sum(days)", "count(days)", 1)} AS avg_lead_time_days
                FROM delivery INNER JOIN suppliers USING (supplier_id) GROUP BY name""",
        ),
    ),
    "q22_supplier_late_rate": Entry(
        supplier.supplier_late_rate,
        typed(
            "name:s late_count:i total_delivered:i late_pct:f",
            f"""SELECT *, {percent("late_count", "total_delivered", 1)} AS late_pct
                FROM (SELECT name, count_if(late) AS late_count, count(*) AS total_delivered
                      FROM delivery INNER JOIN suppliers USING (supplier_id) GROUP BY name)
                WHERE total_delivered >= 5""",
        ),
    ),
    "q23_supplier_spend_top": Entry(
        supplier.supplier_spend_top,
        typed(
            "name:s total_spend:f",
            """SELECT name, sum(total_spend) AS total_spend FROM spend INNER JOIN suppliers USING (supplier_id)
               GROUP BY name ORDER BY 2 DESC, 1 LIMIT 20""",
        ),
    ),
    "q24_supplier_spend_rank": Entry(
        supplier.supplier_spend_rank,
        typed(
            "name:s total_spend:f spend_rank:i",
            """SELECT name, total_spend, rank() OVER (ORDER BY total_spend DESC) AS spend_rank
               FROM (SELECT name, sum(total_spend) AS total_spend
                     FROM spend INNER JOIN suppliers USING (supplier_id) GROUP BY name)""",
        ),
    ),
    "q25_good_rating_slow_suppliers": Entry(
        supplier.good_rating_slow_suppliers,
        typed(
            "name:s rating:f",
            """SELECT s.name, s.rating FROM suppliers s
               INNER JOIN (SELECT supplier_id FROM delivery GROUP BY supplier_id
                           HAVING sum(days) > 14 * count(days)) slow USING (supplier_id)
               WHERE s.rating * (SELECT count(rating) FROM suppliers) > (SELECT sum(rating) FROM suppliers)""",
        ),
    ),
}

CUSTOMER = {
    "q26_customer_ltv_top": Entry(
        customer.customer_ltv_top,
        typed(
            "name:s lifetime_value:f",
            """SELECT name, sum(net) AS lifetime_value FROM live_sale INNER JOIN customers USING (customer_id)
               GROUP BY name ORDER BY lifetime_value DESC, name LIMIT 20""",
        ),
    ),
    "q27_segment_revenue_share": Entry(
        customer.segment_revenue_share,
        typed(
            "segment:s revenue:f pct:f",
            f"""SELECT segment, sum(net) AS revenue,
                       {percent("sum(net)", "(SELECT sum(net) FROM live_sale)", 2)} AS pct
                FROM live_sale INNER JOIN customers USING (customer_id) GROUP BY segment""",
        ),
    ),
    "q28_churn_risk": Entry(
        lambda ds: customer.churn_risk(ds, limit=None),
        typed(
            "customer_id:i name:s",
            f"""SELECT c.customer_id, c.name FROM customers c
                LEFT JOIN (SELECT customer_id, max(order_date) AS latest FROM sales_orders GROUP BY customer_id) o
                  USING (customer_id)
                WHERE o.latest IS NULL OR o.latest <= {NOW} - INTERVAL 6 MONTH""",
        ),
    ),
    "q29_order_frequency": Entry(
        customer.order_frequency,
        typed(
            "order_count_bucket:s num_customers:i",
            """SELECT CASE WHEN n > 10 THEN '10+' WHEN n > 3 THEN '4-10' WHEN n > 0 THEN '1-3' ELSE '0' END
                        AS order_count_bucket, count(*) AS num_customers
               FROM (SELECT c.customer_id, count(o.so_id) AS n
                     FROM customers c LEFT JOIN sales_orders o USING (customer_id) GROUP BY c.customer_id)
               GROUP BY 1""",
        ),
    ),
    "q30_rfm": Entry(
        lambda ds: customer.rfm(ds, limit=None),
        typed(
            "customer_id:i name:s recency_days:i frequency:i monetary:f",
            """SELECT c.customer_id, c.name, DATE '2001-08-02' - max(s.order_date) AS recency_days,
                      count(DISTINCT s.so_id) AS frequency, sum(s.net) AS monetary
               FROM live_sale s INNER JOIN customers c USING (customer_id) GROUP BY c.customer_id, c.name""",
        ),
    ),
}

WINDOWS = {
    "q31_latest_order_per_customer": Entry(
        lambda ds: windows.latest_order_per_customer(ds, limit=None),
        typed(
            "so_id:i customer_id:i warehouse_id:i employee_id:i order_date:d ship_date:d status:s created_at:t rn:i",
            """SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, so_id DESC) AS rn
               FROM sales_orders QUALIFY rn = 1""",
        ),
    ),
    "q32_product_revenue_quartile": Entry(
        lambda ds: windows.product_revenue_quartile(ds, limit=None),
        typed(
            "product_id:i revenue:f revenue_quartile:i",
            """SELECT product_id, revenue, ntile(4) OVER (ORDER BY revenue DESC, product_id) AS revenue_quartile
               FROM (SELECT product_id, sum(gross) AS revenue FROM sale GROUP BY product_id)""",
        ),
    ),
    "q33_order_gap": Entry(
        lambda ds: windows.order_gap(ds, limit=None),
        typed(
            "customer_id:i order_date:d days_since_prev_order:i",
            """SELECT customer_id, order_date,
                      order_date - lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, so_id)
                        AS days_since_prev_order
               FROM sales_orders WHERE status <> 'cancelled'""",
        ),
    ),
    "q34_first_last_price": Entry(
        lambda ds: windows.first_last_price(ds, limit=None),
        typed(
            "product_id:i first_price:f latest_price:f",
            """SELECT product_id, arg_min(unit_price, so_item_id) AS first_price,
                      arg_max(unit_price, so_item_id) AS latest_price
               FROM sales_order_items GROUP BY product_id""",
        ),
    ),
}

_ROLLING = f"""SELECT day, revenue, {mean("sum(revenue) OVER w", "count(revenue) OVER w", 2)} AS rolling_7day_avg
               FROM (SELECT order_date AS day, sum(gross) AS revenue FROM live_sale GROUP BY order_date)
               WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

WINDOWS |= {
    "q35_rolling_7day_revenue": Entry(
        windows.rolling_7day_revenue,
        typed("day:d revenue:f rolling_7day_avg:f", f"{_ROLLING} ORDER BY day LIMIT 60"),
    ),
    "q35_rolling_7day_revenue_all": Entry(
        lambda ds: windows.rolling_7day_revenue(ds, limit=None), typed("day:d revenue:f rolling_7day_avg:f", _ROLLING)
    ),
    "q36_employee_percentile": Entry(
        windows.employee_percentile,
        typed(
            "employee_id:i orders_handled:i percentile:f",
            f"""SELECT employee_id, orders_handled,
                       {quotient("rank() OVER (ORDER BY orders_handled) - 1", "nullif(count(*) OVER () - 1, 0)", 3)} AS percentile
                FROM (SELECT employee_id, count(*) AS orders_handled FROM sales_orders GROUP BY employee_id)""",
        ),
    ),
    "q37_order_value_cume_dist": Entry(
        lambda ds: windows.order_value_cume_dist(ds, limit=None),
        typed(
            "so_id:i order_total:f cume_dist:f",
            f"""SELECT so_id, gross_total AS order_total,
                       {quotient("count(*) OVER (ORDER BY gross_total)", "count(*) OVER ()", 3)} AS cume_dist
                FROM order_value""",
        ),
    ),
}

_CHAIN_LOCAL = {
    "links": """SELECT movement_id, product_id, warehouse_id, movement_date, 1 AS step
                FROM inventory_movements WHERE movement_type = 'inbound'
                UNION ALL
                SELECT m.movement_id, m.product_id, m.warehouse_id, m.movement_date, x.step + 1
                FROM links x INNER JOIN inventory_movements m USING (product_id, warehouse_id)
                WHERE x.step < 5 AND m.movement_date > x.movement_date""",
}


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


HIERARCHY = {
    "q38_org_chart": Entry(
        hierarchies.org_chart,
        recursive(
            typed(
                "employee_id:i manager_id:i name:s depth:i",
                """SELECT e.employee_id, e.manager_id, e.first_name || ' ' || e.last_name AS name, r.depth
                   FROM reports r INNER JOIN employees e USING (employee_id)""",
                reports="""SELECT employee_id, 1 AS depth FROM employees WHERE manager_id IS NULL
                           UNION ALL
                           SELECT e.employee_id, r.depth + 1 FROM reports r, employees e
                           WHERE r.employee_id = e.manager_id""",
            )
        ),
    ),
    "q39_category_tree": Entry(
        hierarchies.category_tree,
        typed(
            "category_id:i name:s parent_category_id:i full_path:s depth:i",
            """SELECT c.category_id, c.name, c.parent_category_id,
                      CASE WHEN p.name IS NULL THEN c.name ELSE p.name || ' > ' || c.name END AS full_path,
                      CASE WHEN p.name IS NULL THEN 1 ELSE 2 END AS depth
               FROM product_categories c LEFT JOIN product_categories p ON c.parent_category_id = p.category_id""",
        ),
    ),
    "q40_date_dimension": Entry(
        hierarchies.calendar_of_orders,
        typed(
            "date:d day_of_week:i month:i quarter:i year:i is_weekend:b",
            """SELECT date, dayofweek(date) AS day_of_week, month(date) AS month, quarter(date) AS quarter,
                      year(date) AS year, dayofweek(date) IN (0, 6) AS is_weekend
               FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))::DATE AS date
                     FROM sales_orders)""",
        ),
    ),
    "q41_movement_chain": Entry(
        hierarchies.movement_chain,
        recursive(
            typed(
                "movement_id:i product_id:i warehouse_id:i movement_type:s quantity:i movement_date:t step:i",
                """SELECT m.*, x.step
                   FROM links x INNER JOIN (SELECT movement_id, product_id, warehouse_id, movement_type, quantity,
                                                   movement_date FROM inventory_movements) m USING (movement_id)
                   ORDER BY m.product_id, m.warehouse_id, m.movement_date, m.movement_id, x.step LIMIT 100""",
                **_CHAIN_LOCAL,
            )
        ),
    ),
    "q41_movement_chain_steps": Entry(
        hierarchies.movement_chain_steps,
        recursive(
            typed(
                "movement_id:i product_id:i warehouse_id:i movement_type:s quantity:i movement_date:t step:i "
                "occurrences:f",
                """SELECT m.movement_id, m.product_id, m.warehouse_id, m.movement_type, m.quantity, m.movement_date,
                          x.step, x.n AS occurrences
                   FROM (SELECT movement_id, step, count(*) AS n FROM links GROUP BY ALL) x
                   INNER JOIN inventory_movements m USING (movement_id)""",
                **_CHAIN_LOCAL,
            )
        ),
    ),
}

KPI = {
    "q42_kpi_snapshot": Entry(
        kpi.kpi_snapshot,
        typed(
            "revenue_30d:f orders_30d:i total_inventory_value:f products_below_reorder:i avg_supplier_lead_time:f",
            f"""SELECT (SELECT sum(net) FROM live_sale WHERE order_date > {NOW} - INTERVAL 30 DAY) AS revenue_30d,
                       (SELECT count(*) FROM sales_orders
                        WHERE order_date > {NOW} - INTERVAL 30 DAY AND status <> 'cancelled') AS orders_30d,
                       total_inventory_value, products_below_reorder, avg_supplier_lead_time
                FROM (SELECT sum(stock_value) AS total_inventory_value,
                             count_if(quantity_on_hand < reorder_level) AS products_below_reorder FROM stocked),
                     (SELECT {mean("sum(days)", "count(days)", 1)} AS avg_supplier_lead_time FROM delivery)""",
        ),
    ),
    "q43_gross_margin": Entry(
        kpi.gross_margin,
        typed(
            "name:s unit_price:f unit_cost:f gross_margin_pct:f",
            f"""SELECT name, unit_price, unit_cost, {percent("unit_price - unit_cost", "unit_price", 1)}
                         AS gross_margin_pct
                FROM products ORDER BY gross_margin_pct DESC, name, product_id LIMIT 20""",
        ),
    ),
    "q43_gross_margin_all": Entry(
        lambda ds: kpi.gross_margin(ds, limit=None),
        typed(
            "name:s unit_price:f unit_cost:f gross_margin_pct:f",
            f"""SELECT name, unit_price, unit_cost, {percent("unit_price - unit_cost", "unit_price", 1)}
                         AS gross_margin_pct FROM products""",
        ),
    ),
    "q44_fulfillment_rate": Entry(
        kpi.fulfillment_rate,
        typed(
            "fulfillment_rate_pct:f",
            f"""SELECT {percent("sum((status = 'delivered')::INT)", "sum((status <> 'cancelled')::INT)", 2)}
                         AS fulfillment_rate_pct FROM sales_orders""",
        ),
    ),
    "q45_inventory_turnover": Entry(
        kpi.inventory_turnover,
        typed(
            "inventory_turnover_ratio:f",
            f"""SELECT {quotient("cost * stock.n", "stock.value", 2)} AS inventory_turnover_ratio
                FROM (SELECT sum(s.quantity * p.unit_cost) AS cost
                      FROM live_sale s INNER JOIN products p USING (product_id)
                      WHERE s.order_date > {NOW} - INTERVAL 1 YEAR),
                     (SELECT sum(stock_value) AS value, count(*) AS n FROM stocked) stock""",
        ),
    ),
}

CASES = {
    "q46_popular_understocked": Entry(
        cases.popular_understocked,
        typed(
            "name:s units_sold:i stockout_adjustments:i",
            """SELECT p.name, sum(l.quantity) AS units_sold, count(DISTINCT m.movement_id) AS stockout_adjustments
               FROM products p INNER JOIN sales_order_items l USING (product_id)
               LEFT JOIN (SELECT movement_id, product_id FROM inventory_movements
                          WHERE movement_type = 'adjustment') m USING (product_id)
               GROUP BY p.name HAVING stockout_adjustments > 0 ORDER BY units_sold DESC, p.name LIMIT 20""",
        ),
    ),
    "q47_full_and_slow_warehouses": Entry(
        cases.full_and_slow_warehouses,
        typed(
            "name:s utilization_pct:f orders_per_employee:f",
            """SELECT f.name, f.utilization_pct, o.orders_per_employee
               FROM (SELECT warehouse_id, warehouse_name AS name,
                            CAST(100 AS DOUBLE) * (sum(quantity_on_hand)::DOUBLE / capacity_units::DOUBLE)
                              AS utilization_pct
                     FROM stocked GROUP BY warehouse_id, warehouse_name, capacity_units
                     HAVING sum(quantity_on_hand) * 100 > 90 * capacity_units::BIGINT) f
               INNER JOIN staffing o USING (warehouse_id)
               WHERE o.orders_per_employee < (SELECT avg(orders_per_employee) FROM staffing)""",
            staffing="""SELECT warehouse_id, count(*)::DOUBLE / count(DISTINCT employee_id) AS orders_per_employee
                        FROM sales_orders GROUP BY warehouse_id""",
        ),
    ),
    "q48_supplier_rank_in_country": Entry(
        cases.supplier_rank_in_country,
        typed(
            "name:s country:s rating:f rank_in_country:i",
            """SELECT name, country, rating,
                      rank() OVER (PARTITION BY country ORDER BY rating DESC NULLS FIRST) AS rank_in_country
               FROM suppliers""",
        ),
    ),
    "q49_never_bought_by_wholesale": Entry(
        lambda ds: cases.never_bought_by_wholesale(ds, limit=None),
        typed(
            "name:s",
            """SELECT DISTINCT name FROM products
               WHERE product_id NOT IN (SELECT product_id FROM sale INNER JOIN customers USING (customer_id)
                                        WHERE segment = 'wholesale')""",
        ),
    ),
    "q50_same_title_pairs": Entry(
        cases.same_title_pairs,
        typed(
            "employee_a:s employee_b:s job_title:s",
            """SELECT a.first_name || ' ' || a.last_name AS employee_a, b.first_name || ' ' || b.last_name AS employee_b,
                      a.job_title
               FROM employees a INNER JOIN employees b USING (job_title)
               WHERE b.employee_id > a.employee_id AND b.warehouse_id <> a.warehouse_id
               ORDER BY a.employee_id, b.employee_id LIMIT 50""",
        ),
    ),
}

LTV = """SELECT c.customer_id, c.name, c.segment, sum(v.order_total) AS lifetime_value, count(*) AS order_count
          FROM customers c INNER JOIN order_value v USING (customer_id)
          WHERE v.status <> 'cancelled' GROUP BY ALL"""
LEDGER_COLUMNS = (
    "movement_id:i product_id:i warehouse_id:i movement_type:s quantity:i reference_id:i reference_type:s movement_date:t"
)


def _ledger_check(kind: str) -> str:
    return typed(LEDGER_COLUMNS, f"SELECT * FROM inventory_movements WHERE movement_type = '{kind}'")


PERFORMANCE = f"""SELECT s.supplier_id, s.name, s.rating, {mean("sum(d.days)", "count(d.days)", 1)}
                            AS avg_lead_time_days,
                          {percent("count_if(NOT d.late)", "count(*)", 1)} AS on_time_pct
                   FROM suppliers s INNER JOIN delivery d USING (supplier_id) GROUP BY ALL"""
UTILIZATION = f"""SELECT w.warehouse_id, w.name, w.capacity_units, coalesce(u.units, 0) AS units_stored,
                          {percent("coalesce(u.units, 0)", "w.capacity_units", 1)} AS utilization_pct
                   FROM warehouses w
                   LEFT JOIN (SELECT warehouse_id, sum(quantity_on_hand) AS units FROM inventory GROUP BY 1) u
                     USING (warehouse_id)"""
_PRODUCTIVITY = """SELECT e.employee_id, concat(e.first_name, ' ', e.last_name) AS employee_name, e.warehouse_id,
                          coalesce(o.n, 0) AS orders_handled
                   FROM employees e
                   LEFT JOIN (SELECT employee_id, count(*) AS n FROM sales_orders WHERE status <> 'cancelled'
                              GROUP BY employee_id) o USING (employee_id)"""


VIEWS = {
    "v01_inventory_status": Entry(
        views.inventory_status,
        typed(
            "product_id:i product_name:s warehouse_id:i warehouse_name:s quantity_on_hand:i quantity_reserved:i "
            "quantity_available:i reorder_level:i needs_reorder:b",
            """SELECT *, quantity_on_hand - quantity_reserved AS quantity_available,
                      reorder_level > quantity_on_hand AS needs_reorder FROM stocked""",
        ),
    ),
    "v02_dead_stock": Entry(
        views.dead_stock,
        typed(
            "product_id:i name:s warehouse_id:i quantity_on_hand:i",
            """SELECT s.product_id, s.product_name AS name, s.warehouse_id, s.quantity_on_hand
               FROM stocked s ANTI JOIN recent_out USING (product_id, warehouse_id) WHERE s.quantity_on_hand > 0""",
        ),
    ),
    "v03_inventory_value_by_warehouse": Entry(
        views.inventory_value_by_warehouse,
        typed(
            "warehouse_id:i name:s inventory_value:f",
            """SELECT warehouse_id, warehouse_name AS name, sum(stock_value) AS inventory_value
               FROM stocked GROUP BY 1, 2""",
        ),
    ),
    "v04_order_revenue": Entry(
        views.order_revenue,
        typed(
            "so_id:i customer_id:i warehouse_id:i employee_id:i order_date:d status:s order_total:f",
            "SELECT * FROM order_value",
        ),
    ),
    "v05_customer_ltv": Entry(
        views.customer_ltv, typed("customer_id:i name:s segment:s lifetime_value:f order_count:i", LTV)
    ),
    "v06_daily_revenue": Entry(
        views.daily_revenue,
        typed("order_date:d revenue:f", "SELECT order_date, sum(net) AS revenue FROM live_sale GROUP BY order_date"),
    ),
    "v07_warehouse_utilization": Entry(
        views.warehouse_utilization,
        typed("warehouse_id:i name:s capacity_units:i units_stored:i utilization_pct:f", UTILIZATION),
    ),
    "v08_employee_productivity": Entry(
        views.employee_productivity,
        typed("employee_id:i employee_name:s warehouse_id:i orders_handled:i", _PRODUCTIVITY),
    ),
    "v09_supplier_performance": Entry(
        views.supplier_performance,
        typed("supplier_id:i name:s rating:f avg_lead_time_days:f on_time_pct:f", PERFORMANCE),
    ),
    "v10_supplier_spend": Entry(
        views.supplier_spend,
        typed(
            "supplier_id:i name:s total_spend:f",
            "SELECT supplier_id, name, total_spend FROM spend INNER JOIN suppliers USING (supplier_id)",
        ),
    ),
}

LEDGER = {
    "l1_receipts": Entry(ledger.receipts, _ledger_check("inbound")),
    "l2_shipments": Entry(ledger.shipments, _ledger_check("outbound")),
    "l3_transfers_out": Entry(ledger.transfers_out, _ledger_check("transfer_out")),
    "l4_transfers_in": Entry(ledger.transfers_in, _ledger_check("transfer_in")),
    "l5_ledger": Entry(
        ledger.derive_movements,
        typed(LEDGER_COLUMNS, "SELECT * FROM inventory_movements WHERE movement_type <> 'adjustment'"),
    ),
}

ENTRIES: dict[str, Entry] = {
    **SALES,
    **INVENTORY,
    **WAREHOUSE,
    **SUPPLIER,
    **CUSTOMER,
    **WINDOWS,
    **HIERARCHY,
    **KPI,
    **CASES,
    **VIEWS,
    **LEDGER,
}

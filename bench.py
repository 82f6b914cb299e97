"""Time the headline queries on stored tables and print one JSON line.

Like a database that is loaded before it is queried: the supplied tables are first written as the
thirteen-table model (the ledger by month); that time is reported as ``load_sec``, not in ``value``.
Each query runs once to warm up and then twice, down to its last row; the faster run counts.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from stockyard.contract import operations, queries
from stockyard.session import build_session, shared_folder
from stockyard.sources.store import SnapshotStore
from stockyard.sources.tpch import load_tpch

HEADLINE = (
    "b1_dead_stock b2_warehouse_movements_30d b3_customer_ltv q01_revenue_by_month q05_revenue_by_category "
    "q07_best_sellers q10_dead_stock q13_inventory_aging q16_stockout_risk q20_warehouse_revenue_share "
    "q22_supplier_late_rate q26_customer_ltv_top q30_rfm q31_latest_order_per_customer q32_product_revenue_quartile "
    "q33_order_gap q34_first_last_price q36_employee_percentile q37_order_value_cume_dist q38_org_chart "
    "q41_movement_chain q42_kpi_snapshot q46_popular_understocked q49_never_bought_by_wholesale "
    "q50_same_title_pairs mv1_monthly_sales mv2_inventory_snapshot"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    source = load_tpch(spark, sf_dir)
    store = SnapshotStore(spark, f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}")
    begun = time.perf_counter()
    store.commit({name: getattr(source, name) for name in source.names})
    loaded = time.perf_counter() - begun
    ds = store.dataset(source.as_of)

    entries = {**queries.ENTRIES, **operations.ENTRIES}
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            begun = time.perf_counter()
            entries[name].plan(ds).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begun)
        seconds[name] = round(min(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "load_sec": round(loaded, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

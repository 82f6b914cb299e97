"""The continuous rules: reservations, receipts, stock reports and live revenue.

Rules that change tables run per micro-batch under its number, so a batch that is delivered again after a failure leaves
what it would have left the first time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockyard.functions.dates import month_of
from stockyard.functions.money import sum_net
from stockyard.operators.commands import STOCK_KEY
from stockyard.streaming.tables import LiveTables

ALL_NOW = {"availableNow": True}
_STATE = "spark.sql.streaming.stateStore"
#: State on local disk behind a cache of bounded size, instead of a map on the heap. A batch commits its changes, not whole
#: files, and rows are not counted, which costs a look-up for each one put. Write buffers of all
#: partitions on an executor share the bound: where they are large, they fill it and every put waits.
_IN_FILES = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.writeBufferSizeMB": "8",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "1000",
}


class state_in_files:
    """Queries started inside keep their state outside the heap; a query holds on to the settings it starts with."""

    def __init__(self, spark: SparkSession):
        self.spark, self.before = spark, {key: spark.conf.get(key, None) for key in _IN_FILES}

    def __enter__(self) -> None:
        for key, value in _IN_FILES.items():
            self.spark.conf.set(key, value)

    def __exit__(self, *_) -> None:
        for key, value in self.before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)


def _run(source: DataFrame, name: str, checkpoint: str, each: Callable[[DataFrame, int], None], trigger: dict) -> StreamingQuery:
    return (
        source.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(each)
        .start()
    )


def reserve_stream(
    lines: DataFrame, tables: LiveTables, orders: Callable[[], DataFrame], checkpoint: str, clock: Callable[[], datetime],
    trigger: dict = ALL_NOW,
) -> StreamingQuery:
    """New sales lines are stored and reserve stock at their order's warehouse.

    ``orders`` gives the sales orders known at the time of a batch. A line that comes before its order waits for it and is
    tried again with every batch.
    """
    return _run(lines, "reserve", checkpoint, lambda batch, number: tables.sell(number, batch, orders(), clock()), trigger)


def receive_stream(
    receipts: DataFrame, tables: LiveTables, checkpoint: str, clock: Callable[[], datetime], trigger: dict = ALL_NOW
) -> StreamingQuery:
    """Receipts raise stock, extend the ledger and complete purchase orders; rejects are kept."""
    return _run(receipts, "receive", checkpoint, lambda batch, number: tables.receive(number, batch, clock()), trigger)


def negative_stock_stream(deltas: DataFrame, inventory: DataFrame) -> DataFrame:
    """Pairs whose stock the deltas seen so far take below zero (update mode, keyed state)."""
    running = deltas.groupBy(*STOCK_KEY).agg(F.sum("delta").alias("delta"))
    level = (F.col("quantity_on_hand") + F.col("delta")).alias("quantity_after")
    return (
        running.join(inventory.select(*STOCK_KEY, "quantity_on_hand"), STOCK_KEY)
        .select(*STOCK_KEY, level)
        .filter("quantity_after < 0")
    )


def live_daily_revenue(lines: DataFrame, orders: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Revenue per order day of active orders. Lines need an event time ``ordered_at``.

    State of a day is dropped once the watermark passes it; later lines are not in the result, so the batch refresh
    remains the reference and ``dropped_lines`` tells how many there were.
    """
    live = orders.filter(F.col("status") != "cancelled").select("so_id")
    timed = lines.withColumn("ordered_at", F.col("ordered_at").cast("timestamp_ltz"))
    return (
        timed.withWatermark("ordered_at", lateness)
        .join(live, "so_id")
        .groupBy(F.window("ordered_at", "1 day").alias("day"))
        .agg(sum_net().alias("revenue"))
        .select(F.col("day.start").cast("date").alias("order_date"), "revenue")
    )


def live_monthly_revenue(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue per month of active orders; one row of state per month."""
    live = orders.filter(F.col("status") != "cancelled").select("so_id")
    return (
        lines.join(live, "so_id")
        .groupBy(month_of(F.col("ordered_at").cast("date")).alias("month"))
        .agg(sum_net().alias("revenue"))
    )


def dropped_lines(query: StreamingQuery) -> int:
    """Rows behind the watermark that a query's recent batches left out."""
    progress = [json.loads(p.json) for p in query.recentProgress]
    return sum(state.get("numRowsDroppedByWatermark", 0) for p in progress for state in p.get("stateOperators", []))

"""The tables that the continuous rules change, each written by one stream.

What changes in place lies in buckets: stock levels by product (written by receipts), reserved units by product (by sales),
purchase orders and their lines by order (by receipts). What is only added lies in a folder for each batch. The last ids
given out are recorded, so that a batch gives new ones without looking for the highest.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.functions.dates import instant
from stockyard.operators.commands import STOCK_KEY, receive_inventory
from stockyard.operators.ids import last_id
from stockyard.schema import TABLES
from stockyard.session import materialize
from stockyard.sources.buckets import Batches, Buckets, Kind

_PAIR = [T.StructField(c, T.LongType()) for c in STOCK_KEY]
_RESERVED = T.StructType([*_PAIR, T.StructField("quantity_reserved", T.IntegerType()), T.StructField("reserved_at", T.TimestampNTZType())])
_LINE = T.StructType([T.StructField(c, T.LongType()) for c in ("po_item_id", "po_id", "product_id")])
_MARK = T.StructType([T.StructField("name", T.StringType()), T.StructField("last_id", T.LongType())])
_REJECT = T.StructType([T.StructField("command_id", T.LongType()), T.StructField("reason", T.StringType())])
_SOLD = TABLES["sales_order_items"].schema
_PLACED = T.StructType([*_SOLD.fields, T.StructField("warehouse_id", T.LongType()), T.StructField("waits", T.BooleanType())])
_NUMBERED = ("inventory", "inventory_movements")


class LiveTables:
    """``n``: buckets of each table; so many that a batch touches a small share of them."""

    def __init__(self, spark: SparkSession, root: str, n: int = 256):
        self.spark = spark

        def buckets(name: str, schema: T.StructType, by: str, count: int = n) -> Buckets:
            return Buckets(spark, f"{root}/{name}", schema, by, count)

        def batches(name: str, schema: T.StructType) -> Batches:
            return Batches(spark, f"{root}/{name}", schema)

        self.levels = buckets("levels", TABLES["inventory"].schema, "product_id")
        self.reserved = buckets("reserved", _RESERVED, "product_id")
        self.purchase_orders = buckets("purchase_orders", TABLES["purchase_orders"].schema, "po_id")
        self.purchase_order_items = buckets("purchase_order_items", TABLES["purchase_order_items"].schema, "po_id")
        self.order_of_line = buckets("order_of_line", _LINE, "po_item_id")
        self.marks = buckets("marks", _MARK, "name", 1)
        self.movements = batches("inventory_movements", TABLES["inventory_movements"].schema)
        self.rejects = batches("rejects", _REJECT)
        self.placed_lines = Batches(spark, f"{root}/sales_order_items", _PLACED, ["waits"])
        self.sold_lines = Kind(self.placed_lines, "not waits", _SOLD.names)
        self.waiting = Kind(self.placed_lines, "waits", _SOLD.names)

    def create(self, ds: Dataset, purchases: bool = True) -> None:
        """Take over stock, and, if there will be receipts, purchase orders and the highest ids of a dataset."""
        self.levels.create(ds.inventory)
        self.reserved.create(ds.inventory.select(*STOCK_KEY, "quantity_reserved", F.lit(None).alias("reserved_at")))
        if not purchases:
            return
        self.purchase_orders.create(ds.purchase_orders)
        self.purchase_order_items.create(ds.purchase_order_items)
        self.order_of_line.create(ds.purchase_order_items.select(*_LINE.names))
        one = self.spark.range(1)
        marks = [one.select(F.lit(name).alias("name"), last_id(getattr(ds, name), TABLES[name].id_column).alias("last_id")) for name in _NUMBERED]
        self.marks.create(marks[0].unionByName(marks[1]))

    def inventory(self, buckets: list[int] | None = None) -> DataFrame:
        """Levels with what is reserved of them."""
        levels, reserved = self.levels.rows(buckets=buckets), self.reserved.rows(buckets=buckets)
        both = levels.drop("quantity_reserved").join(reserved, STOCK_KEY, "left")
        return both.withColumns(
            {
                "quantity_reserved": F.coalesce("quantity_reserved", F.lit(0)),
                "last_updated": F.greatest("last_updated", "reserved_at"),
            }
        ).select(*levels.columns)

    # --- one batch each; a batch that is repeated leaves what the first run would have left ------------

    def sell(self, batch_id: int, lines: DataFrame, orders: DataFrame, as_of: datetime) -> None:
        """Store new sales lines and reserve stock at their order's warehouse; lines without an order wait for it.

        Nothing is reserved where there is no stock row. A line is written once, with its warehouse, and read back from there.
        """
        arrived = lines.select(*_SOLD.names).unionByName(self.waiting.last(batch_id))
        placed = arrived.join(orders.select("so_id", "warehouse_id"), "so_id", "left")
        self.placed_lines.put(batch_id, placed.withColumn("waits", F.col("warehouse_id").isNull()))
        known = self.placed_lines.of(batch_id).filter("not waits")
        wanted = known.groupBy(*STOCK_KEY).agg(F.sum("quantity").alias("wanted"))
        stocked = self.levels.rows(buckets=self.levels.touched(known)).select(*STOCK_KEY)

        def change(old: DataFrame) -> DataFrame:
            rows = stocked.join(old, STOCK_KEY, "left").join(wanted, STOCK_KEY, "left")
            return rows.select(
                *STOCK_KEY,
                (F.coalesce("quantity_reserved", F.lit(0)) + F.coalesce("wanted", F.lit(0))).alias("quantity_reserved"),
                F.when(F.col("wanted").isNotNull(), instant(as_of)).otherwise(F.col("reserved_at")).alias("reserved_at"),
            )

        self.reserved.update(batch_id + 1, known, change)

    def receive(self, batch_id: int, receipts: DataFrame, as_of: datetime) -> None:
        """Receipts (command_id, po_item_id, quantity) raise levels, extend the ledger and complete orders; rejects are kept.

        Opens the orders and products of the batch and nothing else.
        """
        version = batch_id + 1
        places = self.order_of_line.rows(buckets=self.order_of_line.touched(receipts))
        named = materialize(places.join(receipts.select("po_item_id"), "po_item_id", "left_semi"))
        touched, stocked = self.purchase_orders.touched(named), self.levels.touched(named)
        marks = {row["name"]: row["last_id"] for row in self.marks.rows(version).collect()}  # a row for each numbered table
        part = Dataset(
            self.spark,
            {
                "purchase_orders": self.purchase_orders.rows(version, touched),
                "purchase_order_items": self.purchase_order_items.rows(version, touched),
                "inventory": self.levels.rows(version, stocked),
                "inventory_movements": self.spark.createDataFrame([], self.movements.schema),
            },
            as_of,
            last_ids=marks,
        )

        def keep(items: DataFrame) -> DataFrame:
            self.purchase_order_items.write(items, version)
            return self.purchase_order_items.rows(version + 1, touched)

        changes = receive_inventory(part, receipts, named, keep)
        self.purchase_orders.write(changes.tables["purchase_orders"], version)
        self.levels.write(changes.tables["inventory"], version)
        self.movements.put(batch_id, changes.appended["inventory_movements"])
        self.rejects.put(batch_id, changes.rejects)
        moved = self.movements.of(batch_id).agg(F.max("movement_id")).first()[0]
        highest = self.levels.rows(version + 1, stocked).agg(F.max("inventory_id")).first()[0]
        now = [("inventory", max(marks["inventory"], highest or 0)), ("inventory_movements", max(marks["inventory_movements"], moved or 0))]
        self.marks.write(self.spark.createDataFrame(now, _MARK), version)

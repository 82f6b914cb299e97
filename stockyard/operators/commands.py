"""Batches of commands applied to table snapshots.

Each function takes a dataset and a DataFrame of commands and returns the tables after the batch,
the appended rows and the rejected commands. A command is applied whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from stockyard.dataset import Dataset
from stockyard.functions.dates import day, instant
from stockyard.operators.ids import assign_ids
from stockyard.operators.positions import SLOT, place
from stockyard.operators.quality import with_defaults
from stockyard.session import materialize

STOCK_KEY = ["product_id", "warehouse_id"]


@dataclass
class Changes:
    tables: dict[str, DataFrame]
    appended: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None

    def apply(self, ds: Dataset) -> Dataset:
        return ds.replace(**self.tables)


def _reasons(*tests: tuple[Column, str]) -> Column:
    """The first reason that applies, or NULL; an unknown test counts as failed."""
    reason = F.lit(None).cast("string")
    for test, text in reversed(tests):
        reason = F.when(F.coalesce(test, F.lit(True)), text).otherwise(reason)
    return reason


def _known(commands: DataFrame, column: str, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: whether ``column`` exists in the parent table."""
    keys = parent.select(F.col(key).alias(column), F.lit(True).alias(flag))
    return commands.join(keys, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


# --- stock levels ----------------------------------------------------------------------------


def merge_stock(ds: Dataset, deltas: DataFrame) -> DataFrame:
    """Inventory after adding ``delta`` per product and warehouse; unseen pairs become new rows."""
    summed = deltas.groupBy(*STOCK_KEY).agg(F.sum("delta").alias("delta"))
    inventory = ds.inventory
    touched = F.col("delta").isNotNull()
    updated = inventory.join(summed, STOCK_KEY, "left").withColumns(
        {
            "quantity_on_hand": (F.col("quantity_on_hand") + F.coalesce("delta", F.lit(0))).cast("int"),
            "last_updated": F.when(touched, instant(ds.as_of)).otherwise(F.col("last_updated")),
        }
    )
    fresh = summed.join(inventory.select(*STOCK_KEY), STOCK_KEY, "left_anti").select(
        *STOCK_KEY, F.col("delta").cast("int").alias("quantity_on_hand")
    )
    fresh = assign_ids(fresh, "inventory_id", ds.numbered("inventory"), *[F.col(c).asc() for c in STOCK_KEY])
    return updated.select(*inventory.columns).unionByName(with_defaults("inventory", fresh, ds))


def negative_stock(inventory: DataFrame, deltas: DataFrame) -> DataFrame:
    """Rows an update would take below zero, with the message the caller reports."""
    summed = deltas.groupBy(*STOCK_KEY).agg(F.sum("delta").alias("delta"))
    after = (F.col("quantity_on_hand") + F.col("delta")).alias("quantity_after")
    return (
        inventory.join(summed, STOCK_KEY)
        .select(*STOCK_KEY, after)
        .filter("quantity_after < 0")
        .withColumn(
            "message",
            F.format_string("stock of product %d at warehouse %d would go negative", *STOCK_KEY),
        )
    )


def update_stock(ds: Dataset, deltas: DataFrame) -> Changes:
    """Apply stock deltas, or none of them if any would leave a negative level."""
    violations = negative_stock(ds.inventory, deltas)
    if not violations.isEmpty():
        return Changes(tables={}, rejects=violations)
    return Changes(tables={"inventory": merge_stock(ds, deltas)}, rejects=violations)


# --- receipts --------------------------------------------------------------------------------


def receive_inventory(
    ds: Dataset,
    commands: DataFrame,
    lines: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda items: items,
) -> Changes:
    """Receipts (command_id, po_item_id, quantity) against purchase lines.

    Adding is free of order, so the batch is summed per line and per stock row. Receiving more than
    ordered is allowed, a negative or unknown quantity and an unknown line are not. Purchase orders
    whose lines are all received become received.

    ``lines``: (po_item_id, po_id, product_id) of the lines that the commands name, if they are known already. ``keep`` may
    store the new lines; what it returns tells which orders are complete.
    """
    asked = lines
    if asked is None:
        known = ds.purchase_order_items.select("po_item_id", "po_id", "product_id")
        asked = known.join(commands.select("po_item_id"), "po_item_id", "left_semi")
    located = asked.join(ds.purchase_orders.select("po_id", "warehouse_id"), "po_id")
    resolved = commands.join(located, "po_item_id", "left").withColumn(
        "reason",
        _reasons((F.col("po_id").isNull(), "unknown purchase line"), (F.col("quantity") < 0, "negative quantity")),
    )
    resolved = materialize(resolved)
    accepted = resolved.filter("reason is null")

    per_line = accepted.groupBy("po_item_id").agg(F.sum("quantity").alias("arrived"))
    items = (
        ds.purchase_order_items.join(per_line, "po_item_id", "left")
        .withColumn(
            "quantity_received", (F.col("quantity_received") + F.coalesce("arrived", F.lit(0))).cast("int")
        )
        .select(*ds.purchase_order_items.columns)
    )
    items = keep(items)
    touched = accepted.select("po_id").distinct()
    orders = complete_purchase_orders(ds, items, touched)

    deltas = accepted.select(*STOCK_KEY, F.col("quantity").alias("delta"))
    moves = assign_ids(
        accepted.select(
            *STOCK_KEY,
            F.lit("inbound").alias("movement_type"),
            F.col("quantity").cast("int").alias("quantity"),
            F.col("po_item_id").alias("reference_id"),
            F.lit("purchase_order").alias("reference_type"),
            "command_id",
        ),
        "movement_id",
        ds.numbered("inventory_movements"),
        F.col("command_id").asc(),
    )
    moves = with_defaults("inventory_movements", moves.drop("command_id"), ds)
    return Changes(
        tables={
            "purchase_order_items": items,
            "purchase_orders": orders,
            "inventory": merge_stock(ds, deltas),
            "inventory_movements": ds.inventory_movements.unionByName(moves),
        },
        appended={"inventory_movements": moves},
        rejects=resolved.filter("reason is not null").select("command_id", "reason"),
    )


def complete_purchase_orders(ds: Dataset, items: DataFrame, touched: DataFrame) -> DataFrame:
    """Headers after completion: touched orders whose every line is received, of any prior status."""
    full = F.bool_and(F.col("quantity_received") >= F.col("quantity_ordered"))
    done = items.groupBy("po_id").agg(full.alias("full")).filter("full").join(touched, "po_id", "left_semi")
    completes = F.coalesce(F.col("full"), F.lit(False)) & (F.col("status") != "received")
    delivered = F.coalesce(F.col("actual_delivery_date"), day(ds.as_of))
    return (
        ds.purchase_orders.join(done, "po_id", "left")
        .withColumns(
            {
                "actual_delivery_date": F.when(completes, delivered).otherwise(F.col("actual_delivery_date")),
                "status": F.when(completes, "received").otherwise(F.col("status")),
            }
        )
        .select(*ds.purchase_orders.columns)
    )


# --- transfers -------------------------------------------------------------------------------


def transfer_stock(ds: Dataset, commands: DataFrame) -> Changes:
    """Transfers (command_id, command_ts, product_id, from_warehouse_id, to_warehouse_id, quantity,
    employee_id), each accepted exactly if the source has enough available stock at its turn.
    """
    valid, rejected = _static_transfer_checks(ds, commands)
    placed = place(valid, *[F.col(c).asc() for c in ("product_id", "command_ts", "command_id")])
    placed = placed.select(*valid.columns, SLOT, F.lit(False).alias("accepted"))
    free = ds.inventory.select(*STOCK_KEY, (F.col("quantity_on_hand") - F.col("quantity_reserved")).cast("bigint").alias("free"))
    done = materialize(_settle(placed, free.join(placed.select("product_id").distinct(), "product_id", "left_semi")))
    short = done.filter("not accepted").select("command_id", F.lit("insufficient stock").alias("reason"))
    done = done.filter("accepted").drop(SLOT)
    rejects = rejected.unionByName(short)

    transfers = assign_ids(done, "transfer_id", ds.numbered("stock_transfers"), F.col("command_ts").asc(), F.col("command_id").asc())
    transfers = materialize(transfers)
    records = transfers.withColumns({"transfer_date": day(ds.as_of), "status": F.lit("completed")})
    records = with_defaults("stock_transfers", records, ds)
    legs = transfers.select(
        "transfer_id",
        "product_id",
        F.inline(
            F.array(
                _leg("from_warehouse_id", "transfer_out", -F.col("quantity")),
                _leg("to_warehouse_id", "transfer_in", F.col("quantity")),
            )
        ),
    )
    moves = assign_ids(
        legs.withColumns({"reference_id": F.col("transfer_id"), "reference_type": F.lit("transfer")}),
        "movement_id",
        ds.numbered("inventory_movements"),
        F.col("transfer_id").asc(),
        F.col("movement_type").desc(),
    )
    moves = with_defaults("inventory_movements", moves.drop("transfer_id"), ds)
    deltas = legs.select(*STOCK_KEY, F.col("quantity").alias("delta"))
    return Changes(
        tables={
            "inventory": merge_stock(ds, deltas),
            "stock_transfers": ds.stock_transfers.unionByName(records),
            "inventory_movements": ds.inventory_movements.unionByName(moves),
        },
        appended={"stock_transfers": records, "inventory_movements": moves},
        rejects=rejects,
    )


def _leg(warehouse: str, kind: str, quantity: Column) -> Column:
    return F.struct(
        F.col(warehouse).alias("warehouse_id"), F.lit(kind).alias("movement_type"), quantity.alias("quantity")
    )


def _static_transfer_checks(ds: Dataset, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = _known(commands, "employee_id", ds.employees, "employee_id", "has_employee")
    checked = _known(checked, "to_warehouse_id", ds.warehouses, "warehouse_id", "has_target")
    checked = checked.withColumn(
        "reason",
        _reasons(
            (F.col("quantity") <= 0, "quantity not positive"),
            (F.col("from_warehouse_id") == F.col("to_warehouse_id"), "same warehouse"),
            (~F.col("has_employee"), "unknown employee"),
            (~F.col("has_target"), "unknown warehouse"),
        ),
    )
    valid = checked.filter("reason is null").select(*commands.columns)
    return valid, checked.filter("reason is not null").select("command_id", "reason")


def _settle(placed: DataFrame, free: DataFrame) -> DataFrame:
    """All commands with their outcome in ``accepted``. Products are independent.

    Commands lie in slots by (product, time, id). What a slot does is a function of the stock it opens with: its outcome holds
    for a range of opening levels at each warehouse and changes beyond. Products within one slot open with the stock at hand;
    the slots of the others get the levels that ``_openings`` finds. Then every slot is settled at once, in one pass.
    """
    touched = placed.select(
        "product_id", SLOT, F.explode(F.array("from_warehouse_id", "to_warehouse_id")).alias("warehouse_id")
    )
    touched = materialize(touched.groupBy("product_id", SLOT, "warehouse_id").agg(F.count("*").alias("uses")))
    spans = touched.groupBy("product_id").agg((F.max(SLOT) > F.min(SLOT)).alias("spans"))
    touched = touched.drop("uses").join(spans, "product_id")
    first = touched.filter("not spans").join(free, STOCK_KEY).select("product_id", SLOT, "warehouse_id", "free")
    shared = materialize(touched.filter("spans").drop("spans"))
    if not shared.isEmpty():
        many = placed.join(shared.select("product_id").distinct(), "product_id", "left_semi")
        first = first.unionByName(_openings(many, shared, free))
    return _fold(placed, first, placed.schema, _outcomes(placed.columns))


_SUMMARY = f"product_id bigint, {SLOT} bigint, warehouse_id bigint, flow bigint, low bigint, high bigint"
_OPENING = f"product_id bigint, {SLOT} bigint, warehouse_id bigint, free bigint, known boolean"


def _openings(commands: DataFrame, touched: DataFrame, free: DataFrame) -> DataFrame:
    """The level at each warehouse with which each slot opens, for products that span several slots.

    A round walks through slots side by side and tells, for each warehouse, what flows and the range of opening levels for which
    it would be the same. Ranges of all rounds are kept and composed over a product's slots; only slots that open outside
    the ranges known of them are walked again. With every round the first of these comes right, so rounds are at most
    the slots of a product; it takes as many as slots have ranges that matter, mostly two or three.
    """
    key = ["product_id", SLOT]
    pieces = touched.join(free.withColumnRenamed("free", "before"), STOCK_KEY, "left")
    summaries = commands.sparkSession.createDataFrame([], f"{_SUMMARY}, version int")
    version = 0
    while True:
        told = pieces.join(summaries, [*key, "warehouse_id"], "left").fillna(-1, ["version"]).fillna(0)
        opening = materialize(told.groupBy("product_id").applyInPandas(_composed, _OPENING))
        wrong = opening.filter("not known")
        if wrong.isEmpty():
            return opening.drop("known")
        asked = commands.join(wrong.select(*key).distinct(), key, "left_semi")
        walked = _fold(asked, wrong.drop("known"), _SUMMARY, _summaries)
        summaries = materialize(summaries.unionByName(walked.withColumn("version", F.lit(version))).repartition("product_id"))
        version += 1


def _composed(told: pd.DataFrame) -> pd.DataFrame:
    """One product's slots in order, each by the range its opening lies in; where none is known the latest flows stand in.

    Rows are slots times warehouses times ranges, however many commands there are.
    """
    levels: dict[int, int] = {}
    out = []
    for (product, slot), piece in told.groupby(["product_id", SLOT], sort=True):
        for warehouse, before in zip(piece["warehouse_id"].tolist(), piece["before"].tolist()):
            levels.setdefault(warehouse, before)
        opening = {w: levels[w] for w in piece["warehouse_id"].tolist()}
        known, flows = False, {}
        for _, rows in piece[piece["version"] >= 0].groupby("version", sort=True):
            flows = dict(zip(rows["warehouse_id"].tolist(), rows["flow"].tolist()))
            ranges = zip(rows["warehouse_id"].tolist(), rows["low"].tolist(), rows["high"].tolist())
            if all(low <= opening[w] <= high for w, low, high in ranges):
                known = True
                break
        out += [(product, slot, w, level, known) for w, level in opening.items()]
        for warehouse, flow in flows.items():
            levels[warehouse] += flow
    return pd.DataFrame(out, columns=["product_id", SLOT, "warehouse_id", "free", "known"])


def _fold(commands: DataFrame, opening: DataFrame, schema, walk: Callable) -> DataFrame:
    """Slots side by side, the commands of each in order behind its opening levels, handed to ``walk``.

    A task streams its slots one after the other and remembers the levels of one only.
    """
    blank = {f.name: F.lit(0).cast(f.dataType) for f in commands.schema.fields if f.dataType != TimestampNTZType()}
    stock = opening.select("product_id", SLOT, "warehouse_id", "free").withColumns(
        {
            **blank,
            "accepted": F.lit(False),
            "product_id": F.col("product_id"),
            SLOT: F.col(SLOT),
            "from_warehouse_id": F.col("warehouse_id"),
            "phase": F.lit(0),
        }
    )
    asked = commands.withColumns({"free": F.lit(0).cast("bigint"), "phase": F.lit(1)})
    queue = (
        asked.unionByName(stock.drop("warehouse_id"), allowMissingColumns=True)
        .repartition("product_id", SLOT)
        .sortWithinPartitions("product_id", SLOT, "phase", "command_ts", "command_id")
    )
    return queue.mapInPandas(walk, schema)


_STEP = ("product_id", SLOT, "phase", "from_warehouse_id", "to_warehouse_id", "quantity", "free")


def _outcomes(columns: list[str]) -> Callable:
    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, left = None, {}
        for batch in batches:
            verdicts = []
            for product, slot, phase, source, target, quantity, stock in zip(*(batch[f].tolist() for f in _STEP)):
                if (product, slot) != key:
                    key, left = (product, slot), {}
                if phase == 0:
                    left[source] = stock
                    verdicts.append(False)
                    continue
                enough = left.get(source, 0) >= quantity
                if enough:
                    left[source] -= quantity
                    left[target] = left.get(target, 0) + quantity
                verdicts.append(enough)
            yield batch.assign(accepted=verdicts).loc[batch["phase"] == 1, columns]

    return settle


_NO_BOUND = 1 << 62


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each slot and warehouse: the flow, and the least and highest opening level with which every outcome is the same.

    While outcomes stay, a level that opens higher is higher by as much at every command: accepted ones bound how far
    it may fall, refused ones how far it may rise.
    """
    names = ["product_id", SLOT, "warehouse_id", "flow", "low", "high"]
    key, start, left, fall, rise = None, {}, {}, {}, {}

    def told() -> list[tuple]:
        return [
            (*key, w, left[w] - begun, max(begun - fall[w], -_NO_BOUND) if w in fall else -_NO_BOUND,
             begun + rise[w] - 1 if w in rise else _NO_BOUND)
            for w, begun in start.items()
        ]

    for batch in batches:
        rows = []
        for product, slot, phase, source, target, quantity, stock in zip(*(batch[f].tolist() for f in _STEP)):
            if (product, slot) != key:
                rows += told()
                key, start, left, fall, rise = (product, slot), {}, {}, {}, {}
            if phase == 0:
                start[source] = left[source] = stock
                continue
            spare = left[source] - quantity  # every warehouse of a slot has an opening here
            if spare >= 0:
                left[source] = spare
                left[target] += quantity
                fall[source] = min(spare, fall.get(source, spare))
            else:
                rise[source] = min(-spare, rise.get(source, -spare))
        yield pd.DataFrame(rows, columns=names)
    yield pd.DataFrame(told(), columns=names)


# --- purchase orders -------------------------------------------------------------------------

_ITEM = "array<struct<product_id:string,quantity:string,unit_cost:string>>"


def create_purchase_orders(ds: Dataset, commands: DataFrame) -> Changes:
    """Orders (command_id, supplier_id, warehouse_id, employee_id, items) from JSON item lists.

    ``items`` is ``[{"product_id": 1, "quantity": 100, "unit_cost": 12.5}, …]``. One bad item
    rejects its order; an empty list makes a header without lines.
    """
    parsed = commands.withColumn("parsed", F.from_json("items", _ITEM))
    listed = F.col("items").isNull() | (F.col("parsed").isNotNull() & F.ltrim("items").startswith("["))
    for column, parent, key in (
        ("supplier_id", ds.suppliers, "supplier_id"),
        ("warehouse_id", ds.warehouses, "warehouse_id"),
        ("employee_id", ds.employees, "employee_id"),
    ):
        parsed = _known(parsed, column, parent, key, f"has_{column}")
    parsed = parsed.withColumn(
        "reason",
        _reasons(
            (~F.col("has_supplier_id"), "unknown supplier"),
            (~F.col("has_warehouse_id"), "unknown warehouse"),
            (~F.col("has_employee_id"), "unknown employee"),
            (~listed, "items are not a list"),
        ),
    )
    items = (
        parsed.filter("reason is null")
        .select("command_id", F.posexplode("parsed").alias("item_no", "item"))
        .select(
            "command_id",
            "item_no",
            F.col("item.product_id").try_cast("bigint").alias("product_id"),
            F.col("item.quantity").try_cast("int").alias("quantity_ordered"),
            F.col("item.unit_cost").try_cast("decimal(38,18)").try_cast("decimal(10,2)").alias("unit_cost"),
        )
    )
    items = _known(items, "product_id", ds.products, "product_id", "has_product")
    bad_item = ~F.col("has_product") | F.coalesce(F.col("quantity_ordered") <= 0, F.lit(True)) | F.col("unit_cost").isNull()
    spoiled = items.filter(bad_item).select("command_id").distinct()

    headers = assign_ids(
        parsed.filter("reason is null").join(spoiled, "command_id", "left_anti"),
        "po_id",
        ds.numbered("purchase_orders"),
        F.col("command_id").asc(),
    ).select("command_id", "po_id", "supplier_id", "warehouse_id", "employee_id")
    headers = materialize(headers)
    orders = with_defaults(
        "purchase_orders",
        headers.withColumns(
            {"order_date": day(ds.as_of), "expected_delivery_date": F.date_add(day(ds.as_of), 14)}
        ),
        ds,
    )
    lines = assign_ids(
        items.join(headers.select("command_id", "po_id"), "command_id"),
        "po_item_id",
        ds.numbered("purchase_order_items"),
        F.col("po_id").asc(),
        F.col("item_no").asc(),
    )
    lines = with_defaults("purchase_order_items", lines, ds)
    bad_items = spoiled.select("command_id", F.lit("bad item").alias("reason"))
    return Changes(
        tables={
            "purchase_orders": ds.purchase_orders.unionByName(orders),
            "purchase_order_items": ds.purchase_order_items.unionByName(lines),
        },
        appended={"purchase_orders": orders, "purchase_order_items": lines},
        rejects=parsed.filter("reason is not null").select("command_id", "reason").unionByName(bad_items),
    )


# --- reservations ----------------------------------------------------------------------------


def reserve_for_sales(ds: Dataset, new_lines: DataFrame) -> DataFrame:
    """Inventory after reserving new sales lines (so_id, product_id, quantity).

    Reserved at the order's warehouse without an availability check; lines whose product has no
    inventory row there reserve nothing.
    """
    wanted = (
        new_lines.groupBy("so_id", "product_id")
        .agg(F.sum("quantity").alias("quantity"))
        .join(ds.sales_orders.select("so_id", "warehouse_id"), "so_id")
        .groupBy(*STOCK_KEY)
        .agg(F.sum("quantity").alias("wanted"))
    )
    hit = F.col("wanted").isNotNull()
    return (
        ds.inventory.join(wanted, STOCK_KEY, "left")
        .withColumns(
            {
                "quantity_reserved": (F.col("quantity_reserved") + F.coalesce("wanted", F.lit(0))).cast("int"),
                "last_updated": F.when(hit, instant(ds.as_of)).otherwise(F.col("last_updated")),
            }
        )
        .select(*ds.inventory.columns)
    )

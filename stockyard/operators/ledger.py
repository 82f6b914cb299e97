"""The signed movement ledger, derived from orders and transfers.

Receipts and transfers in are positive, shipments and transfers out negative. Ids are functions
of (movement type, reference), so a partial rebuild yields the same rows as a full one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.schema import MOVEMENT_TYPES

LEDGER_COLUMNS = (
    "movement_id",
    "product_id",
    "warehouse_id",
    "movement_type",
    "quantity",
    "reference_id",
    "reference_type",
    "movement_date",
)


def movement_code(movement_type: str) -> int:
    """Last digit of a movement id; the digits before it are the reference."""
    return MOVEMENT_TYPES.index(movement_type) + 1


def _entries(
    df: DataFrame, movement_type: str, reference_type: str, *, warehouse: str, quantity: str, reference: str, date: str
) -> DataFrame:
    return df.selectExpr(
        f"{reference} * 10 + {movement_code(movement_type)} as movement_id",
        "product_id",
        f"{warehouse} as warehouse_id",
        f"'{movement_type}' as movement_type",
        f"cast({quantity} as int) as quantity",
        f"cast({reference} as bigint) as reference_id",
        f"'{reference_type}' as reference_type",
        f"cast({date} as timestamp_ntz) as movement_date",
    )


def receipts(ds: Dataset) -> DataFrame:
    """Received purchase lines with a quantity, on the delivery date."""
    headers = ds.purchase_orders.filter("status = 'received'").select("po_id", "warehouse_id", "actual_delivery_date")
    return _entries(
        ds.purchase_order_items.filter("quantity_received > 0").join(headers, "po_id"),
        "inbound",
        "purchase_order",
        warehouse="warehouse_id",
        quantity="quantity_received",
        reference="po_item_id",
        date="actual_delivery_date",
    )


def shipments(ds: Dataset) -> DataFrame:
    """Lines of shipped or delivered sales, on the shipping date."""
    headers = ds.sales_orders.filter("status in ('shipped', 'delivered')").select("so_id", "warehouse_id", "ship_date")
    return _entries(
        ds.sales_order_items.join(headers, "so_id"),
        "outbound",
        "sales_order",
        warehouse="warehouse_id",
        quantity="-quantity",
        reference="so_item_id",
        date="ship_date",
    )


def _transfer_leg(ds: Dataset, movement_type: str, warehouse: str, quantity: str) -> DataFrame:
    return _entries(
        ds.stock_transfers.filter("status = 'completed'"),
        movement_type,
        "transfer",
        warehouse=warehouse,
        quantity=quantity,
        reference="transfer_id",
        date="transfer_date",
    )


def transfers_out(ds: Dataset) -> DataFrame:
    return _transfer_leg(ds, "transfer_out", "from_warehouse_id", "-quantity")


def transfers_in(ds: Dataset) -> DataFrame:
    return _transfer_leg(ds, "transfer_in", "to_warehouse_id", "quantity")


def derive_movements(ds: Dataset) -> DataFrame:
    """The whole ledger. A filter on ``movement_type`` prunes the other branches from the plan."""
    return (
        receipts(ds).unionByName(shipments(ds)).unionByName(transfers_out(ds)).unionByName(transfers_in(ds))
    )


def outbound_since(ds: Dataset, bound: Column) -> DataFrame:
    """Outbound rows strictly after an instant (no upper bound)."""
    return ds.movements_since(bound).filter(F.col("movement_type") == "outbound")

"""Declared model: columns, keys, references, checks and defaults of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NOW = "now"  # default that means "the as-of instant"

INT = T.IntegerType()
BIG = T.LongType()  # every identifier: order keys pass 2**31 long before the target size
TEXT = T.StringType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    default: object = None
    max_length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    id_column: str
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)  # rule name -> SQL predicate
    owner: ForeignKey | None = None  # lines removed together with this header

    @property
    def schema(self) -> T.StructType:
        # Nullability is a rule to report on, not a promise the reader may optimise with.
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def _col(name, type_, required=False, default=None, max_length=None):
    return Column(name, type_, required, default, max_length)


def _key(name, type_=BIG):
    return Column(name, type_, True)


# The words each state column may hold.
SEGMENTS = ("retail", "wholesale", "online", "enterprise")
PURCHASE_STATES = ("pending", "shipped", "received", "cancelled")
SALE_STATES = ("pending", "shipped", "delivered", "cancelled")
MOVEMENT_TYPES = ("inbound", "outbound", "transfer_in", "transfer_out", "adjustment")
TRANSFER_STATES = ("pending", "in_transit", "completed", "cancelled")


def _one_of(column: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"{column} in ({listed})"


_CREATED = _col("created_at", STAMP, True, NOW)

_ALL = (
    Table(
        "warehouses",
        (
            _key("warehouse_id"),
            _col("name", TEXT, True, max_length=100),
            _col("address", TEXT, max_length=200),
            _col("city", TEXT, True, max_length=100),
            _col("state", TEXT, max_length=100),
            _col("country", TEXT, True, max_length=100),
            _col("capacity_units", BIG, True),
            _CREATED,
        ),
        ("warehouse_id",),
        "warehouse_id",
        checks={"capacity_units_positive": "capacity_units > 0"},
    ),
    Table(
        "product_categories",
        (
            _key("category_id"),
            _col("name", TEXT, True, max_length=100),
            _col("parent_category_id", BIG),
        ),
        ("category_id",),
        "category_id",
        foreign_keys=(ForeignKey("parent_category_id", "product_categories", "category_id"),),
    ),
    Table(
        "suppliers",
        (
            _key("supplier_id"),
            _col("name", TEXT, True, max_length=150),
            _col("contact_name", TEXT, max_length=100),
            _col("email", TEXT, max_length=150),
            _col("phone", TEXT, max_length=20),
            _col("country", TEXT, max_length=100),
            _col("rating", T.DecimalType(2, 1)),
            _CREATED,
        ),
        ("supplier_id",),
        "supplier_id",
        checks={"rating_0_to_5": "rating between 0 and 5"},
    ),
    Table(
        "employees",
        (
            _key("employee_id"),
            _col("warehouse_id", BIG, True),
            _col("manager_id", BIG),
            _col("first_name", TEXT, True, max_length=50),
            _col("last_name", TEXT, True, max_length=50),
            _col("email", TEXT, True, max_length=150),
            _col("phone", TEXT, max_length=20),
            _col("job_title", TEXT, True, max_length=100),
            _col("hire_date", DATE, True),
            _CREATED,
        ),
        ("employee_id",),
        "employee_id",
        unique=(("email",),),
        foreign_keys=(
            ForeignKey("warehouse_id", "warehouses", "warehouse_id"),
            ForeignKey("manager_id", "employees", "employee_id"),
        ),
    ),
    Table(
        "products",
        (
            _key("product_id"),
            _col("sku", TEXT, True, max_length=30),
            _col("name", TEXT, True, max_length=200),
            _col("category_id", BIG, True),
            _col("supplier_id", BIG, True),
            _col("unit_price", MONEY, True),
            _col("unit_cost", MONEY, True),
            _col("reorder_level", INT, True, 10),
            _col("reorder_qty", INT, True, 50),
            _CREATED,
        ),
        ("product_id",),
        "product_id",
        unique=(("sku",),),
        foreign_keys=(
            ForeignKey("category_id", "product_categories", "category_id"),
            ForeignKey("supplier_id", "suppliers", "supplier_id"),
        ),
        checks={"unit_price_not_negative": "unit_price >= 0", "unit_cost_not_negative": "unit_cost >= 0"},
    ),
    Table(
        "customers",
        (
            _key("customer_id"),
            _col("name", TEXT, True, max_length=150),
            _col("email", TEXT, max_length=150),
            _col("phone", TEXT, max_length=20),
            _col("address", TEXT, max_length=200),
            _col("city", TEXT, max_length=100),
            _col("country", TEXT, max_length=100),
            _col("segment", TEXT, max_length=50),
            _CREATED,
        ),
        ("customer_id",),
        "customer_id",
        unique=(("email",),),
        checks={"segment_known": _one_of("segment", SEGMENTS)},
    ),
    Table(
        "purchase_orders",
        (
            _key("po_id"),
            _col("supplier_id", BIG, True),
            _col("warehouse_id", BIG, True),
            _col("employee_id", BIG, True),
            _col("order_date", DATE, True),
            _col("expected_delivery_date", DATE),
            _col("actual_delivery_date", DATE),
            _col("status", TEXT, True, "pending", 20),
            _CREATED,
        ),
        ("po_id",),
        "po_id",
        foreign_keys=(
            ForeignKey("supplier_id", "suppliers", "supplier_id"),
            ForeignKey("warehouse_id", "warehouses", "warehouse_id"),
            ForeignKey("employee_id", "employees", "employee_id"),
        ),
        checks={"status_known": _one_of("status", PURCHASE_STATES)},
    ),
    Table(
        "purchase_order_items",
        (
            _key("po_item_id"),
            _col("po_id", BIG, True),
            _col("product_id", BIG, True),
            _col("quantity_ordered", INT, True),
            _col("quantity_received", INT, True, 0),
            _col("unit_cost", MONEY, True),
        ),
        ("po_item_id",),
        "po_item_id",
        foreign_keys=(
            ForeignKey("po_id", "purchase_orders", "po_id"),
            ForeignKey("product_id", "products", "product_id"),
        ),
        checks={
            "quantity_ordered_positive": "quantity_ordered > 0",
            "quantity_received_not_negative": "quantity_received >= 0",
        },
        owner=ForeignKey("po_id", "purchase_orders", "po_id"),
    ),
    Table(
        "sales_orders",
        (
            _key("so_id"),
            _col("customer_id", BIG, True),
            _col("warehouse_id", BIG, True),
            _col("employee_id", BIG, True),
            _col("order_date", DATE, True),
            _col("ship_date", DATE),
            _col("status", TEXT, True, "pending", 20),
            _CREATED,
        ),
        ("so_id",),
        "so_id",
        foreign_keys=(
            ForeignKey("customer_id", "customers", "customer_id"),
            ForeignKey("warehouse_id", "warehouses", "warehouse_id"),
            ForeignKey("employee_id", "employees", "employee_id"),
        ),
        checks={"status_known": _one_of("status", SALE_STATES)},
    ),
    Table(
        "sales_order_items",
        (
            _key("so_item_id"),
            _col("so_id", BIG, True),
            _col("product_id", BIG, True),
            _col("quantity", INT, True),
            _col("unit_price", MONEY, True),
            _col("discount_pct", T.DecimalType(4, 2), True, 0),
        ),
        ("so_item_id",),
        "so_item_id",
        foreign_keys=(
            ForeignKey("so_id", "sales_orders", "so_id"),
            ForeignKey("product_id", "products", "product_id"),
        ),
        checks={"quantity_positive": "quantity > 0", "discount_0_to_100": "discount_pct between 0 and 100"},
        owner=ForeignKey("so_id", "sales_orders", "so_id"),
    ),
    Table(
        "inventory",
        (
            _key("inventory_id"),
            _col("product_id", BIG, True),
            _col("warehouse_id", BIG, True),
            _col("quantity_on_hand", INT, True, 0),
            _col("quantity_reserved", INT, True, 0),
            _col("last_updated", STAMP, True, NOW),
        ),
        ("inventory_id",),
        "inventory_id",
        unique=(("product_id", "warehouse_id"),),
        foreign_keys=(
            ForeignKey("product_id", "products", "product_id"),
            ForeignKey("warehouse_id", "warehouses", "warehouse_id"),
        ),
        checks={
            "on_hand_not_negative": "quantity_on_hand >= 0",
            "reserved_not_negative": "quantity_reserved >= 0",
        },
    ),
    Table(
        "stock_transfers",
        (
            _key("transfer_id"),
            _col("product_id", BIG, True),
            _col("from_warehouse_id", BIG, True),
            _col("to_warehouse_id", BIG, True),
            _col("employee_id", BIG, True),
            _col("quantity", INT, True),
            _col("transfer_date", DATE, True),
            _col("status", TEXT, True, "pending", 20),
        ),
        ("transfer_id",),
        "transfer_id",
        foreign_keys=(
            ForeignKey("product_id", "products", "product_id"),
            ForeignKey("from_warehouse_id", "warehouses", "warehouse_id"),
            ForeignKey("to_warehouse_id", "warehouses", "warehouse_id"),
            ForeignKey("employee_id", "employees", "employee_id"),
        ),
        checks={
            "quantity_positive": "quantity > 0",
            "two_warehouses": "to_warehouse_id != from_warehouse_id",
            "status_known": _one_of("status", TRANSFER_STATES),
        },
    ),
    Table(
        "inventory_movements",
        (
            _key("movement_id"),
            _col("product_id", BIG, True),
            _col("warehouse_id", BIG, True),
            _col("movement_type", TEXT, True, max_length=20),
            _col("quantity", INT, True),
            _col("reference_id", BIG),
            _col("reference_type", TEXT, max_length=20),
            _col("movement_date", STAMP, True, NOW),
        ),
        ("movement_id", "movement_date"),
        "movement_id",
        foreign_keys=(
            ForeignKey("product_id", "products", "product_id"),
            ForeignKey("warehouse_id", "warehouses", "warehouse_id"),
        ),
        checks={"movement_type_known": _one_of("movement_type", MOVEMENT_TYPES)},
    ),
)

TABLES: dict[str, Table] = {table.name: table for table in _ALL}

# Parents come before children; the ledger is derived, not loaded.
LOAD_ORDER: tuple[str, ...] = tuple(t.name for t in _ALL if t.name != "inventory_movements")

"""Summaries kept current by signed changes instead of rebuilds.

A change of a table is the rows it held before and those it holds after, signed -1 and +1. The change of a join of A and B
is (change of A) with the old B, and the new A with (change of B), so only what meets a changed row is read. For each key
of a summary the sums and counts behind its figures are kept, not the figures: a mean cannot be changed, its sum and count
can. Rows of inner joins appear and vanish with their counts. The kept rows lie in buckets, of which a change rewrites those it
touches; a count that has come down to nothing stays as a row of nothing and does not show.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.functions.dates import lead_days
from stockyard.functions.money import percent_of, quotient
from stockyard.plans import views
from stockyard.session import materialize
from stockyard.sources.buckets import Buckets

SIGN = "_sign"
_MONEY = T.DecimalType(38, 2)
_LONG = T.LongType()


@dataclass(frozen=True)
class Change:
    before: DataFrame
    after: DataFrame

    def signed(self) -> DataFrame:
        return self.before.withColumn(SIGN, F.lit(-1)).unionByName(self.after.withColumn(SIGN, F.lit(1)))


@dataclass(frozen=True)
class Net:
    """A change by its different rows, each with the number of times it came less those it went."""

    rows: DataFrame

    def signed(self) -> DataFrame:
        return self.rows


Changes = Mapping[str, Change | Net]


def difference(old: Dataset, new: Dataset, *tables: str) -> dict[str, Net]:
    """The changes between two states, by comparing whole tables: for loads without a feed of changes.

    Both are read once and meet in one shuffle.
    """
    found = {}
    for name in tables:
        both = Change(getattr(old, name), getattr(new, name)).signed()
        net = both.groupBy(*getattr(old, name).columns).agg(F.sum(SIGN).alias(SIGN)).filter(f"{SIGN} <> 0")
        found[name] = Net(materialize(net))
    return found


def _whole(table: DataFrame) -> DataFrame:
    return table.withColumn(SIGN, F.lit(1))


def _joined(
    left: str, right: str, key: str, old: Dataset | None, new: Dataset, changes: Changes | None,
) -> list[DataFrame]:
    """Signed rows by which the join of two tables changes; all of them if there was nothing before."""
    if old is None:
        return [_whole(getattr(new, left)).join(getattr(new, right), key)]
    parts = []
    if left in changes:
        parts.append(changes[left].signed().join(getattr(old, right), key))
    if right in changes:
        parts.append(getattr(new, left).join(changes[right].signed(), key))
    return parts


def _single(name: str, old: Dataset | None, new: Dataset, changes: Changes | None) -> list[DataFrame]:
    if old is None:
        return [_whole(getattr(new, name))]
    return [changes[name].signed()] if name in changes else []


def _times(value: Column | str) -> Column:
    return F.sum(F.col(SIGN) * (F.col(value) if isinstance(value, str) else value))


def _when(test: Column) -> Column:
    return F.sum(F.when(test, F.col(SIGN)).otherwise(F.lit(0)))


def _sums(parts: list[DataFrame], key: str, fields: Mapping[str, Column]) -> list[DataFrame]:
    return [part.groupBy(key).agg(*[c.alias(name) for name, c in fields.items()]) for part in parts]


# --- what each summary keeps -------------------------------------------------------------------


def supplier_parts(old: Dataset | None, new: Dataset, changes: Changes | None = None) -> list[DataFrame]:
    """Changes of orders, timed orders, days, orders on time, lines and spend for each supplier."""
    lead = lead_days()
    on_time = F.coalesce(F.col("actual_delivery_date") <= F.col("expected_delivery_date"), F.lit(False))
    orders = [views.received(part) for part in _single("purchase_orders", old, new, changes)]
    lines = [views.received(part) for part in _joined("purchase_order_items", "purchase_orders", "po_id", old, new, changes)]
    cost = F.col("quantity_received") * F.col("unit_cost")
    return _sums(
        orders,
        "supplier_id",
        {"orders": F.sum(SIGN), "timed": _when(lead.isNotNull()), "days": _times(F.coalesce(lead, F.lit(0))), "on_time": _when(on_time)},
    ) + _sums(lines, "supplier_id", {"lines": F.sum(SIGN), "spend": _times(cost)})


def warehouse_parts(old: Dataset | None, new: Dataset, changes: Changes | None = None) -> list[DataFrame]:
    """Changes of units, valued rows, value, staff and active orders for each warehouse."""
    stock = _single("inventory", old, new, changes)
    valued = _joined("inventory", "products", "product_id", old, new, changes)
    staff = _single("employees", old, new, changes)
    orders = _handled(old, new, changes)
    return (
        _sums(stock, "warehouse_id", {"units": _times("quantity_on_hand")})
        + _sums(valued, "warehouse_id", {"valued": F.sum(SIGN), "value": _times(F.col("quantity_on_hand") * F.col("unit_cost"))})
        + _sums(staff, "warehouse_id", {"staff": F.sum(SIGN)})
        + _sums(orders, "warehouse_id", {"orders": F.sum(SIGN)})
    )


def _handled(old: Dataset | None, new: Dataset, changes: Changes | None) -> list[DataFrame]:
    """Active orders at their employee's home warehouse, signed."""

    def pick(orders: DataFrame) -> DataFrame:  # orders have a warehouse of their own
        return views.active(orders).drop("warehouse_id")

    def home(ds: Dataset) -> DataFrame:
        return ds.employees.select("employee_id", "warehouse_id")

    if old is None:
        return [home(new).join(pick(_whole(new.sales_orders)), "employee_id")]
    parts = []
    if "employees" in changes:
        parts.append(changes["employees"].signed().select("employee_id", "warehouse_id", SIGN).join(pick(old.sales_orders), "employee_id"))
    if "sales_orders" in changes:
        parts.append(home(new).join(pick(changes["sales_orders"].signed()), "employee_id"))
    return parts


_SNAPSHOT = ["product_id", "warehouse_id", "quantity_on_hand", "quantity_available", "needs_reorder"]


def snapshot_parts(old: Dataset | None, new: Dataset, changes: Changes | None = None) -> list[DataFrame]:
    """Rows of the inventory snapshot that come and go, signed."""
    rows = _joined("inventory", "products", "product_id", old, new, changes)
    houses = lambda ds: ds.warehouses.select("warehouse_id")
    parts = [part.join(houses(new if old is None else old), "warehouse_id") for part in rows]
    if old is not None and "warehouses" in changes:
        gone = changes["warehouses"].signed().select("warehouse_id", SIGN)
        parts.append(new.inventory.join(new.products, "product_id").join(gone, "warehouse_id"))
    shown = {
        "quantity_available": F.col("quantity_on_hand") - F.col("quantity_reserved"),
        "needs_reorder": F.col("quantity_on_hand") < F.col("reorder_level"),
    }
    return [p.withColumns(shown).groupBy(*_SNAPSHOT).agg(F.sum(SIGN).alias("copies")) for p in parts]


@dataclass(frozen=True)
class Kept:
    parts: Callable[..., list[DataFrame]]
    key: tuple[str, ...]
    fields: Mapping[str, T.DataType]
    by: str
    follows: tuple[str, ...]  # the tables whose changes it meets

    def schema(self) -> T.StructType:
        keys = {"needs_reorder": T.BooleanType(), "quantity_on_hand": T.IntegerType(), "quantity_available": T.IntegerType()}
        return T.StructType(
            [T.StructField(k, keys.get(k, _LONG)) for k in self.key] + [T.StructField(f, kind) for f, kind in self.fields.items()]
        )

    def merged(self, parts: list[DataFrame]) -> DataFrame:
        """One row for each key: everything added up."""
        full = [
            p.select(*self.key, *[(F.col(f) if f in p.columns else F.lit(0)).cast(kind).alias(f) for f, kind in self.fields.items()])
            for p in parts
        ]
        sums = [F.sum(f).cast(kind).alias(f) for f, kind in self.fields.items()]
        return reduce(DataFrame.unionByName, full).groupBy(*self.key).agg(*sums)


KEPT = {
    "mv_supplier_metrics": Kept(
        supplier_parts, ("supplier_id",),
        {"orders": _LONG, "timed": _LONG, "days": _LONG, "on_time": _LONG, "lines": _LONG, "spend": _MONEY}, "supplier_id",
        ("purchase_orders", "purchase_order_items"),
    ),
    "mv_warehouse_summary": Kept(
        warehouse_parts, ("warehouse_id",),
        {"units": _LONG, "valued": _LONG, "value": _MONEY, "staff": _LONG, "orders": _LONG}, "warehouse_id",
        ("inventory", "products", "employees", "sales_orders"),
    ),
    "mv_inventory_snapshot": Kept(
        snapshot_parts, tuple(_SNAPSHOT), {"copies": _LONG}, "product_id", ("inventory", "products", "warehouses"),
    ),
}


class LiveSummaries:
    """The three summaries whose figures are means, shares and joins, or some of them; ``n``: buckets of each."""

    def __init__(self, spark: SparkSession, root: str, n: int = 64, names: Iterable[str] = tuple(KEPT)):
        self.kept = {name: KEPT[name] for name in names}
        self.tables = {name: Buckets(spark, f"{root}/{name}", kept.schema(), kept.by, n) for name, kept in self.kept.items()}

    def create(self, ds: Dataset) -> None:
        for name, kept in self.kept.items():
            self.tables[name].create(kept.merged(kept.parts(None, ds)))

    def apply(self, version: int, old: Dataset, new: Dataset, changes: Changes) -> dict[str, list[int]]:
        """Bring all summaries from ``old`` to ``new``; returns the buckets written. Versions count up from 1, and one that
        comes again leaves what it left before."""
        written = {}
        for name, kept in self.kept.items():
            parts = kept.parts(old, new, changes)
            if parts:
                delta = materialize(kept.merged(parts))
                written[name] = self.tables[name].update(version, delta, lambda rows, d=delta, k=kept: k.merged([rows, d]))
        return written

    def supplier_metrics(self, ds: Dataset) -> DataFrame:
        kept = self.tables["mv_supplier_metrics"].rows().filter("orders > 0 and lines > 0")
        return ds.suppliers.select("supplier_id", "name", "rating").join(
            kept.select(
                "supplier_id",
                quotient(F.col("days"), F.nullif("timed", F.lit(0)), 1).alias("avg_lead_time_days"),
                percent_of(F.col("on_time"), F.col("orders"), 1).alias("on_time_pct"),
                F.col("spend").alias("total_spend"),
            ),
            "supplier_id",
        )

    def warehouse_summary(self, ds: Dataset) -> DataFrame:
        kept = self.tables["mv_warehouse_summary"].rows().filter("valued > 0 and staff > 0")
        joined = ds.warehouses.select("warehouse_id", "name", "capacity_units").join(kept, "warehouse_id")
        return joined.select(
            "warehouse_id",
            "name",
            percent_of(F.col("units"), F.col("capacity_units"), 1).alias("utilization_pct"),
            F.col("value").alias("inventory_value"),
            F.col("orders").alias("total_orders"),
        )

    def inventory_snapshot(self) -> DataFrame:
        kept = self.tables["mv_inventory_snapshot"].rows().filter("copies > 0")
        return kept.select(*_SNAPSHOT)

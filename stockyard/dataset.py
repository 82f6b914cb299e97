"""The thirteen tables plus the instant that stands for "now"."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.schema import TABLES


class Dataset:
    """Lazily built tables, reachable as attributes (``ds.sales_orders``).

    ``as_of`` replaces the database clock, so a result depends on its inputs alone.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
        as_of: datetime,
        months_since: Callable[[str, Column], DataFrame] | None = None,
        origin: str | None = None,
        last_ids: Mapping[str, int] | None = None,
    ):
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self.spark = spark
        self.as_of = as_of
        self.origin = origin  # the folder of the source tables, for those who stream them
        self.last_ids = last_ids or {}  # recorded highest ids, where the table itself need not be asked
        self._months_since = months_since
        self._sources = dict(tables)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._built:
            if name not in self._sources:
                raise AttributeError(f"table {name} is not part of this dataset")
            source = self._sources[name]
            self._built[name] = source() if callable(source) else source
        return self._built[name]

    def has(self, name: str) -> bool:
        return name in self._sources

    @property
    def names(self) -> list[str]:
        return [name for name in TABLES if name in self._sources]

    def replace(self, **tables: DataFrame) -> Dataset:
        """The same dataset with some tables exchanged."""
        pruned = None if {"inventory_movements", "sales_orders", "sales_order_items"} & set(tables) else self._months_since
        return Dataset(self.spark, {**self._sources, **self._built, **tables}, self.as_of, pruned, self.origin, self.last_ids)

    def numbered(self, name: str) -> DataFrame:
        """Rows whose highest id is the last one given out: the table, or one row with the recorded id."""
        if name not in self.last_ids:
            return getattr(self, name)
        return self.spark.range(1).select(F.lit(self.last_ids[name]).cast("bigint").alias(TABLES[name].id_column))

    def movements_since(self, bound: Column) -> DataFrame:
        """Ledger rows strictly after an instant; a stored ledger opens only the months concerned."""
        return self._since("inventory_movements", bound).filter(F.col("movement_date") > bound)

    def sales_since(self, bound: Column) -> tuple[DataFrame, DataFrame]:
        """Sales orders dated strictly after an instant (a date is its midnight), and lines among which theirs are.

        Stored orders and lines open only the months concerned. Join the two on so_id.
        """
        orders = self._since("sales_orders", bound).filter(F.col("order_date").cast("timestamp_ntz") > bound)
        return orders, self._since("sales_order_items", bound)

    def _since(self, name: str, bound: Column) -> DataFrame:
        stored = self._months_since and name in self._sources
        return self._months_since(name, bound) if stored else getattr(self, name)

    def register_views(self) -> None:
        for name in self.names:
            getattr(self, name).createOrReplaceTempView(name)

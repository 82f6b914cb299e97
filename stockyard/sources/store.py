"""Versioned Parquet tables behind one small manifest per version.

A commit writes new folders for the tables it changes and then publishes the next manifest, which fails if somebody else
has published that version meanwhile. Readers see the state before or after, never half of it; a failed commit leaves
folders nothing refers to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.functions.dates import month_of
from stockyard.schema import TABLES

LEDGER = "inventory_movements"
MONTH = "movement_month"
ORDERS, LINES = "sales_orders", "sales_order_items"
ORDER_MONTH = "order_month"
#: Month folders; a line lies in the month of its order.
MONTHS = {LEDGER: MONTH, ORDERS: ORDER_MONTH, LINES: ORDER_MONTH}
#: How the files of a month are sorted, so that row groups can be skipped.
SORTED = {LEDGER: ("warehouse_id", "movement_date"), ORDERS: ("order_date", "so_id"), LINES: ("so_id",)}
_MANIFEST = "_manifest-"


class VersionConflict(RuntimeError):
    """Another writer has published the version this one was going to publish."""


class Staged(dict):
    """Name -> unpublished folder, and the version they were made from."""

    def __init__(self, version: int):
        super().__init__()
        self.version = version


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ---------------------------------------------------------------------------

    def manifest(self) -> dict:
        """``{"version": n, "tables": {name: path}, "meta": {...}}``"""
        root, files = self._path(self.root), self._files()
        found = files.listStatus(root) if files.exists(root) else []
        last = max((s.getPath().getName() for s in found if s.getPath().getName().startswith(_MANIFEST)), default=None)
        if last is None:
            return {"version": 0, "tables": {}, "meta": {}}
        stream = files.open(self._path(f"{self.root}/{last}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def open(self, path: str, name: str | None = None) -> DataFrame:
        """A version folder; tables of the model are read with their declared schema."""
        if name not in TABLES:
            return self.spark.read.parquet(path)
        return self.spark.read.schema(_stored_schema(name)).parquet(path)

    def has(self, name: str) -> bool:
        return name in self.manifest()["tables"]

    def _visible(self, name: str, current: dict) -> DataFrame:
        if name not in current["tables"]:
            raise KeyError(f"{name} was never published in {self.root}")
        return self.open(current["tables"][name], name)

    def read(self, name: str) -> DataFrame:
        """The published version of a table or snapshot."""
        return self._shaped(name, self._visible(name, self.manifest()))

    def dataset(self, as_of: datetime, current: dict | None = None) -> Dataset:
        """All published tables of the model, as of one manifest."""
        current = current or self.manifest()
        tables = [n for n in TABLES if n in current["tables"]]
        opened = {n: self._visible(n, current) for n in tables}  # folders are listed once
        frames = {n: self._shaped(n, df) for n, df in opened.items()}

        def months_since(name: str, bound: Column) -> DataFrame:
            return self._shaped(name, opened[name].filter(F.col(MONTHS[name]) >= month_of(bound.cast("date"))))

        return Dataset(self.spark, frames, as_of, months_since)

    def ledger_between(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Movements from ``start`` up to but without ``end``, opening only the months concerned.

        The month folder is derived from the date, so its bounds have to be stated beside it.
        """
        rows = self._visible(LEDGER, self.manifest())
        if start is not None:
            rows = rows.filter((F.col("movement_date") >= F.lit(start)) & (F.col(MONTH) >= month_of(F.lit(start))))
        if end is not None:
            rows = rows.filter((F.col("movement_date") < F.lit(end)) & (F.col(MONTH) <= month_of(F.lit(end))))
        return rows.drop(MONTH)

    # --- writing ---------------------------------------------------------------------------

    def stage(self, tables: Mapping[str, DataFrame], current: dict | None = None) -> Staged:
        """Write unpublished folders; returns name -> path. ``current``: the manifest the tables were made from."""
        staged = Staged((current or self.manifest())["version"])
        version = staged.version + 1
        for name, df in tables.items():
            path = f"{self.root}/{name}/v{version:08d}-{uuid.uuid4().hex[:8]}"
            if name in MONTHS:
                write_by_month(name, self._in_months(name, df, tables.get(ORDERS), current), path)
            else:
                _typed(name, df).write.parquet(path)
            staged[name] = path
        return staged

    def _in_months(self, name: str, rows: DataFrame, orders: DataFrame | None, current: dict | None) -> DataFrame:
        """Rows with the month of their folder; a line without an order has none."""
        rows = _typed(name, rows)
        if name == LEDGER:
            return rows.withColumn(MONTH, month_of("movement_date"))
        if name == ORDERS:
            return rows.withColumn(ORDER_MONTH, month_of("order_date"))
        current = current or self.manifest()
        if orders is None and ORDERS in current["tables"]:
            orders = self._visible(ORDERS, current)
        if orders is None:
            return rows.withColumn(ORDER_MONTH, F.lit(None).cast("date"))
        dates = orders.select("so_id", month_of("order_date").alias(ORDER_MONTH))
        return rows.join(dates, "so_id", "left").select(*rows.columns, ORDER_MONTH)

    def publish(self, staged: Staged, meta: Mapping[str, object] | None = None) -> int:
        """Point the next manifest at staged folders; ``meta`` entries are merged."""
        current = self.manifest()
        if current["version"] != staged.version:
            raise VersionConflict(f"{self.root} is at version {current['version']}, not {staged.version}")
        updated = {
            "version": staged.version + 1,
            "tables": {**current["tables"], **staged},
            "meta": {**current["meta"], **(meta or {})},
        }
        jvm = self.spark._jvm
        draft = self._path(f"{self.root}/.{_MANIFEST}.{uuid.uuid4().hex}")
        out = self._files().create(draft, True)
        try:
            out.write(bytearray(json.dumps(updated).encode()))
        finally:
            out.close()
        target = self._path(f"{self.root}/{_MANIFEST}{updated['version']:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._hadoop())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE  # an existing manifest is never replaced
        try:
            context.rename(draft, target, never)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise VersionConflict(f"{self.root}: version {updated['version']} was published meanwhile") from error
            raise
        return updated["version"]

    def commit(
        self, tables: Mapping[str, DataFrame], meta: Mapping[str, object] | None = None, current: dict | None = None
    ) -> int:
        return self.publish(self.stage(tables, current), meta)

    def retried(self, step: Callable[[dict], int | None], attempts: int = 5) -> int | None:
        """Run ``step`` on the current manifest, and again on the next one if another writer was first."""
        for left in reversed(range(attempts)):
            try:
                return step(self.manifest())
            except VersionConflict:
                if not left:
                    raise
        return None

    def expire(self, names: Iterable[str] | None = None) -> list[str]:
        """Delete version folders the manifest does not name; run it when no reader is active."""
        current, files, removed = self.manifest()["tables"], self._files(), []
        for name in names or current:
            used = current[name].rsplit("/", 1)[1]
            for status in files.listStatus(self._path(f"{self.root}/{name}")):
                path = status.getPath()
                if path.getName() != used:
                    files.delete(path, True)
                    removed.append(f"{self.root}/{name}/{path.getName()}")
        return removed

    # --- helpers ---------------------------------------------------------------------------

    def _shaped(self, name: str, df: DataFrame) -> DataFrame:
        return df.select(*TABLES[name].column_names) if name in TABLES else df

    def _hadoop(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self):
        return self._path(self.root).getFileSystem(self._hadoop())


def _stored_schema(name: str) -> T.StructType:
    month = [T.StructField(MONTHS[name], T.DateType())] if name in MONTHS else []
    return T.StructType([*TABLES[name].schema.fields, *month])


def _typed(name: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c.name).cast(c.type) for c in TABLES[name].columns]) if name in TABLES else df


def write_by_month(name: str, rows: DataFrame, path: str) -> None:
    """``rebalance`` gathers small months into few files and splits a month that holds a large share of the rows over
    several tasks."""
    month = MONTHS[name]
    (
        rows.hint("rebalance", month)
        .sortWithinPartitions(month, *SORTED[name])
        .write.mode("overwrite")
        .partitionBy(month)
        .parquet(path)
    )


def repartition_ledger(store: SnapshotStore, movements: DataFrame) -> int:
    """Move an unpartitioned ledger into month folders; published only if no row got lost."""
    staged = store.stage({LEDGER: movements})
    expected, written = movements.count(), store.open(staged[LEDGER], LEDGER).count()
    if expected != written:
        raise RuntimeError(f"ledger copy has {written} rows instead of {expected}")
    return store.publish(staged)

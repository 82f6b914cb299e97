"""CSV in and out, with the loading rules of the model."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.functions.dates import instant
from stockyard.operators.quality import validate
from stockyard.schema import LOAD_ORDER, NOW, TABLES, Table
from stockyard.session import require_conf
from stockyard.sources.quoted_lines import records
from stockyard.sources.store import SnapshotStore

# Stands for a quoted empty field while an unquoted one is read as NULL.
_QUOTED_EMPTY = "\u0001quoted-empty\u0001"


def read_csv(spark: SparkSession, table: str, path: str, as_of: datetime, multi_line: bool = False) -> DataFrame:
    """One table from a CSV file or folder whose header names the columns, in any order.

    An unquoted empty field is NULL, a quoted one is an empty text. Columns the file lacks take
    their default; a NULL that is written out stays NULL. The first bad value fails the job.
    ``multi_line`` accepts line breaks inside quotes, at the price of reading the text twice; a quote inside a field has to be
    doubled and the field quoted.
    """
    require_conf(spark)
    spec = TABLES[table]
    options = {"header": True, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    unknown = [c for c in header if c not in spec.column_names]
    if unknown:
        raise ValueError(f"{path}: {table} has no columns {unknown}")
    schema = T.StructType([T.StructField(c, spec.column(c).type, True) for c in header])
    strict = {"escape": '"', "nullValue": "", "emptyValue": _QUOTED_EMPTY, "mode": "FAILFAST"}
    if multi_line:
        parsed = F.from_csv("record", schema.simpleString(), strict)
        rows = records(spark, path).select(parsed.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(schema).options(**strict, header=True, enforceSchema=False).csv(path)
    return rows.select(*[_loaded(spec, name, name in header, as_of) for name in spec.column_names])


def _loaded(spec: Table, name: str, present: bool, as_of: datetime) -> Column:
    column = spec.column(name)
    if not present:
        value = instant(as_of) if column.default == NOW else F.lit(column.default)
        return value.cast(column.type).alias(name)
    if isinstance(column.type, T.StringType):
        return F.when(F.col(name) == _QUOTED_EMPTY, "").otherwise(F.col(name)).alias(name)
    return F.col(name)


def read_folder(spark: SparkSession, folder: str, as_of: datetime, multi_line: bool = False) -> Dataset:
    """All twelve loadable tables, ``<folder>/<table>.csv`` each."""
    tables = {t: read_csv(spark, t, f"{folder}/{t}.csv", as_of, multi_line) for t in LOAD_ORDER}
    return Dataset(spark, tables, as_of)


def load_folder(
    spark: SparkSession, folder: str, store: SnapshotStore, as_of: datetime, multi_line: bool = False
) -> Dataset:
    """Load every table or none: nothing is published unless all rows parse and all rules hold."""
    raw = read_folder(spark, folder, as_of, multi_line)
    staged = store.stage({name: getattr(raw, name) for name in LOAD_ORDER})
    loaded = Dataset(spark, {name: store.open(path, name) for name, path in staged.items()}, as_of)
    broken = validate(loaded).filter("violations > 0").orderBy("table", "rule").collect()  # a row per rule at most
    if broken:
        raise ValueError("; ".join(f"{r['table']}.{r['rule']}: {r['violations']} rows" for r in broken))
    store.publish(staged)
    return loaded


def next_ids(ds: Dataset) -> DataFrame:
    """Last used id per table, at least 1, from which new ids count up."""
    parts = [
        getattr(ds, name).agg(
            F.lit(name).alias("table"),
            F.coalesce(F.max(TABLES[name].id_column), F.lit(1)).cast("bigint").alias("last_id"),
        )
        for name in ds.names
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def save_csv(df: DataFrame, path: str) -> None:
    """Write with a header; NULL is an unquoted and empty text a quoted empty field."""
    df.write.options(header=True, escape='"', nullValue="", emptyValue='""').csv(path)


def as_dictionaries(df: DataFrame) -> DataFrame:
    """Rows as JSON texts, one column ``value``, for a client at the edge."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))

"""Integrity rules as a distributed report.

Per table one aggregate pass covers every row rule. Keys and references are tagged with their rule
and grouped before they are compared, so a key that fills a third of a table is one row per task in
the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.functions.dates import instant
from stockyard.schema import NOW, TABLES, Table


def validate(ds: Dataset) -> DataFrame:
    """One row per rule: table, rule, kind, violations, sample_key (one offending key)."""
    parts = [row_rules(TABLES[name], getattr(ds, name)) for name in ds.names]
    return reduce(DataFrame.unionByName, [*parts, _unique_keys(ds), _references(ds)])


def row_rules(spec: Table, rows: DataFrame) -> DataFrame:
    """Rules that concern one row: required values, text lengths and checks, in one pass."""
    broken: list[tuple[str, str, str]] = []
    for column in spec.columns:
        if column.required:
            broken.append((f"{column.name}_not_null", "not_null", f"{column.name} is null"))
        if column.max_length and isinstance(column.type, T.StringType):
            broken.append((f"{column.name}_length", "length", f"length({column.name}) > {column.max_length}"))
    for rule, predicate in spec.checks.items():
        # A check that evaluates to unknown is satisfied.
        broken.append((rule, "check", f"not coalesce({predicate}, true)"))
    key = f"cast({spec.id_column} as string)"
    counted = rows.agg(
        *[
            F.expr(f"struct(count_if({test}) as n, min(case when {test} then {key} end) as key) as r{i}")
            for i, (_, _, test) in enumerate(broken)
        ]
    )
    lines = ", ".join(
        f"struct('{spec.name}' as table, '{rule}' as rule, '{kind}' as kind, r{i}.n as violations, "
        f"r{i}.key as sample_key)"
        for i, (rule, kind, _) in enumerate(broken)
    )
    return counted.selectExpr(f"inline(array({lines}))")


def _unique_keys(ds: Dataset) -> DataFrame:
    """Surplus rows of repeated keys; a key with a NULL part never repeats.

    All number keys of all tables go through one shuffle as numbers, the others through a second one.
    """
    rules: list[tuple[str, str, str]] = []
    numbers, texts = [], []
    for name in ds.names:
        spec = TABLES[name]
        number_keys, text_keys = [], []
        for columns in (spec.primary_key, *spec.unique):
            kind = "primary_key" if columns == spec.primary_key else "unique"
            if len(columns) == 1 and isinstance(spec.column(columns[0]).type, (T.LongType, T.IntegerType)):
                number_keys.append(tagged(len(rules), F.col(columns[0]).cast("bigint")))
            else:
                known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
                text = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
                text_keys.append(tagged(len(rules), F.when(known, text)))
            rules.append((name, "_".join(columns) + "_unique", kind))
        for keys, parts in ((number_keys, numbers), (text_keys, texts)):
            if keys:
                parts.append(getattr(ds, name).select(F.inline(F.array(*keys))))
    found = [_repeats(reduce(DataFrame.unionByName, parts)) for parts in (numbers, texts) if parts]
    return _with_all_rules(ds, rules, reduce(DataFrame.unionByName, found) if found else None)


def _repeats(keys: DataFrame) -> DataFrame:
    counted = keys.filter("key is not null").groupBy("rule_no", "key").count()
    return (
        counted.filter("count > 1")
        .groupBy("rule_no")
        .agg(F.sum(F.col("count") - 1).alias("violations"), F.min(F.col("key").cast("string")).alias("sample_key"))
    )


def _references(ds: Dataset) -> DataFrame:
    """Rows that refer to nothing; NULL refers to nothing and is allowed.

    Every reference of every table is checked by one anti join of (rule, key) pairs.
    """
    rules: list[tuple[str, str, str]] = []
    wanted: dict[str, list[Column]] = {}
    offered: dict[str, list[Column]] = {}
    for name in ds.names:
        for fk in TABLES[name].foreign_keys:
            if ds.has(fk.table):
                wanted.setdefault(name, []).append(tagged(len(rules), F.col(fk.column).cast("bigint")))
                offered.setdefault(fk.table, []).append(tagged(len(rules), F.col(fk.key).cast("bigint")))
                rules.append((name, f"{fk.column}_exists", "foreign_key"))
    if not rules:
        return _with_all_rules(ds, rules, None)

    def gathered(columns: dict[str, list[Column]]) -> DataFrame:
        pairs = [getattr(ds, name).select(F.inline(F.array(*tags))) for name, tags in columns.items()]
        return reduce(DataFrame.unionByName, pairs).filter("key is not null")

    used = gathered(wanted).groupBy("rule_no", "key").count()
    found = (
        used.join(gathered(offered), ["rule_no", "key"], "left_anti")
        .groupBy("rule_no")
        .agg(F.sum("count").alias("violations"), F.min(F.col("key").cast("string")).alias("sample_key"))
    )
    return _with_all_rules(ds, rules, found)


def tagged(rule_no: int, key: Column) -> Column:
    return F.struct(F.lit(rule_no).alias("rule_no"), key.alias("key"))


def _with_all_rules(ds: Dataset, rules: list[tuple[str, str, str]], found: DataFrame | None) -> DataFrame:
    """The findings, with a zero for each rule that found nothing (one row per rule on both sides)."""
    names = ds.spark.createDataFrame(
        [(i, *rule) for i, rule in enumerate(rules)], "rule_no int, table string, rule string, kind string"
    )
    if found is None:
        found = ds.spark.createDataFrame([], "rule_no int, violations bigint, sample_key string")
    return names.join(found, "rule_no", "left").select(
        "table", "rule", "kind", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"), "sample_key"
    )


def delete_with_lines(ds: Dataset, header: str, ids: DataFrame) -> Dataset:
    """Remove headers and the lines they own; ``ids`` holds the header key."""
    spec = TABLES[header]
    key = spec.id_column
    gone = ids.select(key).distinct()
    changed = {header: getattr(ds, header).join(gone, key, "left_anti")}
    for name in ds.names:
        owner = TABLES[name].owner
        if owner and owner.table == header:
            target = gone.withColumnRenamed(key, owner.column)
            changed[name] = getattr(ds, name).join(target, owner.column, "left_anti")
    return ds.replace(**changed)


def with_defaults(table: str, rows: DataFrame, ds: Dataset) -> DataFrame:
    """Complete appended rows: absent columns take their default, the rest stays as given."""
    spec = TABLES[table]
    columns = []
    for column in spec.columns:
        if column.name in rows.columns:
            value = F.col(column.name)
        else:
            value = instant(ds.as_of) if column.default == NOW else F.lit(column.default)
        columns.append(value.cast(column.type).alias(column.name))
    return rows.select(*columns)

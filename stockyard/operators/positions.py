"""Global positions, ranks and running sums without a single-task window.

Rows are range-partitioned and sorted once, and written to the checkpoint folder so that their
slot (partition) and index never change. What crosses slots is summarised per slot: one or two
rows for each partition, which is the proven size bound of everything broadcast here. A key or
value that holds a third of all rows simply spans a third of the slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.functions.money import quotient
from stockyard.session import materialize

SLOT = "_slot"
_INDEX = "_index"
_INDEX_BITS = 33  # layout of monotonically_increasing_id: partition number above, row index below


def place(df: DataFrame, *order: Column) -> DataFrame:
    """Range-partition and sort by ``order``; adds the fixed slot and the index inside it.

    ``order`` should end in a unique key so that equal leading values can spread over slots.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    mark = F.monotonically_increasing_id()
    placed = materialize(placed.withColumn("_mark", mark))
    return (
        placed.withColumn(SLOT, F.shiftright("_mark", _INDEX_BITS))
        .withColumn(_INDEX, F.col("_mark").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
        .drop("_mark")
    )


def with_positions(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``position`` (1-based, global) and keep the slot."""
    placed = place(df, *order)
    earlier = W.orderBy(SLOT).rowsBetween(W.unboundedPreceding, -1)  # one row per slot
    offsets = (
        placed.groupBy(SLOT)
        .agg(F.count("*").alias("_rows"))
        .select(SLOT, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), SLOT)
        .withColumn("position", F.col("_offset") + F.col(_INDEX) + 1)
        .drop("_offset", _INDEX)
    )


def with_ranks(df: DataFrame, value: str, tie_break: Sequence[str], *, descending: bool = False) -> DataFrame:
    """Add position, tie_first, tie_last and total for the order of ``value`` over all rows.

    ``tie_first`` is the SQL rank; ``tie_last / total`` the cumulative distribution. Descending
    order puts unknown values first, ascending order last.
    """
    lead = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    placed = with_positions(df, lead, *[F.col(c).asc_nulls_last() for c in tie_break])
    ties = W.partitionBy(SLOT, value)
    local = placed.withColumn("_first", F.min("position").over(ties)).withColumn(
        "_last", F.max("position").over(ties)
    )
    # Only the first and the last value of a slot can continue in a neighbour: their runs, and nothing else, are
    # gathered across slots, by aggregates that combine before they shuffle.
    held = F.struct(F.col(value).alias("value"))
    ends = placed.groupBy(SLOT).agg(F.min_by(held, "position").alias("_head"), F.max_by(held, "position").alias("_tail"))
    outer = F.col(value).eqNullSafe(F.col("_head.value")) | F.col(value).eqNullSafe(F.col("_tail.value"))
    edges = (
        placed.join(F.broadcast(ends), SLOT)
        .filter(outer)
        .groupBy(F.col(value).alias("edge"))
        .agg(F.min("position").alias("_edge_first"), F.max("position").alias("_edge_last"))
    )
    total = placed.agg(F.max("position")).scalar()
    return (
        local.join(F.broadcast(edges), F.col(value).eqNullSafe(F.col("edge")), "left")
        .withColumn("tie_first", F.coalesce("_edge_first", "_first"))
        .withColumn("tie_last", F.coalesce("_edge_last", "_last"))
        .withColumn("total", total)
        .drop("edge", "_edge_first", "_edge_last", "_first", "_last", SLOT)
    )


def rank() -> Column:
    return F.col("tie_first")


def percent_rank(digits: int) -> Column:
    rows = F.col("total")
    return F.coalesce(quotient(F.col("tie_first") - 1, F.nullif(rows - 1, F.lit(0).cast("bigint")), digits), F.lit(0))


def cume_dist(digits: int) -> Column:
    return quotient(F.col("tie_last"), F.col("total"), digits)


def ntile(tiles: int) -> Column:
    """Tile number of a position: the first ``total % tiles`` tiles hold one row more."""
    size, spare = F.floor(F.col("total") / tiles), F.col("total") % tiles
    wide = spare * (size + 1)
    at = F.col("position") - 1
    # A tile of the narrow kind exists only when size > 0.
    narrow = spare + F.floor((at - wide) / F.greatest(size, F.lit(1)))
    return (F.when(at < wide, F.floor(at / (size + 1))).otherwise(narrow) + 1).cast("bigint")


def carry_in(placed: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """What earlier slots hold of the key a slot begins with: slot, keys, slot totals in order.

    Returns one row for each (slot, earlier-or-own slot of that key) in a form callers fold with a
    window: columns ``keys``, ``_slot``, ``_need`` (True on the row that asks) and the totals.
    Two rows per slot at most.
    """
    sums = placed.groupBy(SLOT, *keys).agg(*[c.alias(n) for n, c in totals.items()])
    edges = sums.groupBy(SLOT).agg(
        F.min(F.struct(*keys)).alias("head"),
        F.max(F.struct(*keys, *totals)).alias("tail"),
    )
    gives = edges.select(SLOT, "tail.*", F.lit(False).alias("_need"))
    zeros = [F.lit(0).cast(sums.schema[n].dataType).alias(n) for n in totals]
    needs = edges.select(SLOT, "head.*", *zeros, F.lit(True).alias("_need"))
    return gives.unionByName(needs)


def earlier_slots(keys: Sequence[str]):
    """Window over ``carry_in`` rows: the same key in strictly earlier slots."""
    return W.partitionBy(*keys).orderBy(SLOT, F.col("_need").desc()).rowsBetween(W.unboundedPreceding, -1)


def with_running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """For each measure add ``<measure>_before``: its sum over earlier rows of the same key.

    ``order`` must be unique inside a key.
    """
    placed = place(df, *[F.col(c).asc() for c in (*keys, *order)])
    before = W.partitionBy(SLOT, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = placed.select(
        "*", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_before") for m in measures]
    )
    edges = carry_in(placed, keys, {f"_{m}": F.sum(m) for m in measures})
    earlier = earlier_slots(keys)
    carried = (
        edges.select(
            SLOT,
            *keys,
            "_need",
            *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_{m}") for m in measures],
        )
        .filter("_need")
        .drop("_need")
    )
    joined = local.join(F.broadcast(carried), [SLOT, *keys], "left")
    sums = {f"{m}_before": F.col(f"{m}_before") + F.coalesce(F.col(f"_{m}"), F.lit(0)) for m in measures}
    return joined.withColumns(sums).drop(SLOT, _INDEX, *[f"_{m}" for m in measures])

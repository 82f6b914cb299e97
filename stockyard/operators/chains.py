"""Chains of strictly later events within a key, counted instead of enumerated.

A chain starts at a starting event and continues with any strictly later event of the same key.
The number of chains that reach an event in step s depends only on its instant:

    reach[1] = 1 for a starting event
    reach[s](t) = sum over earlier instants u of rows(u) * reach[s-1](u)

so running sums over (key, instant) replace the self-joins, whose output grows with the s-th power
of a key's events. Events are dealt once, by their key, and summed where they lie. Keys that one task should not hold are
placed by ranges instead; those that span several slots are finished from per-slot totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.operators.positions import SLOT, carry_in, earlier_slots, place

_COUNT = "decimal(38,0)"  # overflow is an error, never a wrong count
_SHORT = "bigint"  # chains of one or two rows of a key: at most the square of its rows
_CHUNK = 10_000
#: Keys are counted by this many hashes; those of a hash with more than so many events are placed by ranges.
_HASHES, HOT_ROWS = 65_536, 1_000_000


def chain_reach(
    events: DataFrame, keys: Sequence[str], instant: str, starts: Column, steps: int = 5
) -> DataFrame:
    """One row per (key, instant): ``reach_2`` … ``reach_<steps>``."""
    counted = events.groupBy(*keys, instant).agg(
        F.count("*").alias("rows"),
        F.count(F.when(starts, True)).alias("begun"),
    )
    placed = place(counted, *[F.col(c).asc() for c in (*keys, instant)])
    last = steps - 1
    grown = _grown(placed, keys, instant, last)

    totals = {"all_local_1": _total(F.col("begun"))}
    for step in range(2, last + 1):
        totals[f"all_local_{step}"] = _total(_times("rows", f"local_{step - 1}"))
    if last > 1:
        totals["all_plain_1"] = _total(F.col("rows"))
    for step in range(2, last):
        totals[f"all_plain_{step}"] = _total(_times("rows", f"plain_{step - 1}"))

    # Across slots: fold the totals of the same key, one or two rows per slot. Only the first and the last key of a slot can
    # lie in others too, so chains are counted for these alone.
    ends = placed.groupBy(SLOT).agg(*[f(F.struct(*keys)).alias(n) for n, f in (("_head", F.min), ("_tail", F.max))])
    key = F.struct(*keys)
    outer = placed.join(F.broadcast(ends), SLOT).filter(key.eqNullSafe(F.col("_head")) | key.eqNullSafe(F.col("_tail")))
    folded = carry_in(_grown(outer.drop("_head", "_tail"), keys, instant, last), keys, totals)
    earlier = earlier_slots(keys)
    for step in range(1, last + 1):
        passed = F.col(f"all_local_{step}")
        for back in range(1, step):
            passed = passed + F.col(f"carry_{step - back}") * F.col(f"all_plain_{back}")
        folded = folded.withColumn(f"carry_{step}", _sum_before(passed, earlier))
    carried = folded.filter("_need").select(SLOT, *keys, *[f"carry_{s}" for s in range(1, last + 1)])

    joined = grown.join(F.broadcast(carried), [SLOT, *keys], "left")
    reach = []
    for step in range(1, last + 1):
        total = F.col(f"local_{step}").cast(_COUNT) + _or_zero(f"carry_{step}")
        for back in range(1, step):
            total = total + _or_zero(f"carry_{step - back}") * F.col(f"plain_{back}").cast(_COUNT)
        reach.append(total.cast(_COUNT).alias(f"reach_{step + 1}"))
    return joined.select(*keys, instant, *reach)


def _grown(placed: DataFrame, keys: Sequence[str], instant: str, last: int) -> DataFrame:
    """Inside a slot: plain_i counts i-step chains of any rows, local_i those begun in the slot."""
    before = W.partitionBy(SLOT, *keys).orderBy(instant).rowsBetween(W.unboundedPreceding, -1)
    grown = placed
    for step in range(1, last + 1):
        kind = _SHORT if step < 3 else _COUNT
        feeds = {f"local_{step}": F.col("begun") if step == 1 else _times("rows", f"local_{step - 1}", kind)}
        if step < last:
            feeds[f"plain_{step}"] = F.col("rows") if step == 1 else _times("rows", f"plain_{step - 1}", kind)
        grown = grown.select("*", *[_sum_before(feed, before, kind).alias(name) for name, feed in feeds.items()])
    return grown


def chain_rows(
    events: DataFrame, keys: Sequence[str], instant: str, starts: Column, steps: int = 5
) -> DataFrame:
    """Each event with every ``step`` it takes part in and in how many chains (``occurrences``).

    Events without a key take part in none. Those without an instant come before all others of their key, and are left out here.
    """
    known = events.filter(reduce(and_, [F.col(c).isNotNull() for c in keys]))
    hashed = F.pmod(F.xxhash64(*keys), F.lit(_HASHES)).alias("_hash")
    hot = [r["_hash"] for r in known.groupBy(hashed).count().filter(F.col("count") > HOT_ROWS).select("_hash").collect()]
    if not hot:
        return _steps(events.columns, _walked(known, keys, instant, starts, steps), starts, steps)
    is_hot = hashed.isin(hot)
    reach = chain_reach(known.filter(is_hot), keys, instant, starts, steps)
    placed = known.filter(is_hot).join(reach, [*keys, instant])
    walked = _walked(known.filter(~is_hot), keys, instant, starts, steps)
    return _steps(events.columns, placed.unionByName(walked), starts, steps)


def _steps(columns: Sequence[str], reached: DataFrame, starts: Column, steps: int) -> DataFrame:
    first = F.when(starts, F.lit(1)).otherwise(0).cast(_COUNT)
    options = [F.struct(F.lit(1).alias("step"), first.alias("occurrences"))]
    options += [
        F.struct(F.lit(s).alias("step"), F.col(f"reach_{s}").alias("occurrences")) for s in range(2, steps + 1)
    ]
    return reached.select(*columns, F.inline(F.array(*options))).filter("occurrences > 0")


def _walked(events: DataFrame, keys: Sequence[str], instant: str, starts: Column, steps: int) -> DataFrame:
    """Events with ``reach_2`` … ``reach_<steps>``, by sums over a key's events in order: up to an instant less those at it."""
    until = W.partitionBy(*keys).orderBy(instant).rangeBetween(W.unboundedPreceding, W.currentRow)
    at = W.partitionBy(*keys, instant)
    reached = events.withColumn("reach_1", F.when(starts, F.lit(1)).otherwise(0).cast(_SHORT))
    for step in range(2, steps + 1):
        kind = _SHORT if step < 4 else _COUNT
        fed = F.col(f"reach_{step - 1}").cast(kind)
        reached = reached.withColumn(f"reach_{step}", (F.sum(fed).over(until) - F.sum(fed).over(at)).cast(kind))
    columns = [F.col(f"reach_{s}").cast(_COUNT).alias(f"reach_{s}") for s in range(2, steps + 1)]
    return reached.filter(F.col(instant).isNotNull()).select(*events.columns, *columns)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times over; built in chunks so no row carries a long array."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(times).cast("bigint") - 1, F.lit(_CHUNK).cast("bigint"))
    piece = F.least(F.lit(_CHUNK).cast("bigint"), F.col(times).cast("bigint") - F.col("_from"))
    return (
        df.withColumn("_from", F.explode(starts))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), piece)))
        .drop("_from", "_copy", times)
    )


def _times(a: str, b: str, kind: str = _COUNT) -> Column:
    return F.col(a).cast(kind) * F.col(b).cast(kind)


def _sum_before(value: Column, window, kind: str = _COUNT) -> Column:
    return F.coalesce(F.sum(value.cast(kind)).over(window), F.lit(0)).cast(kind)


def _total(value: Column) -> Column:
    return F.sum(value.cast(_COUNT)).cast(_COUNT)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(_COUNT)

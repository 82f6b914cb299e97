"""Positions, ranks, running sums, chains and trees against brute force, with one key dominating."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockyard.operators import chains
from stockyard.operators.chains import chain_reach, chain_rows, repeat_rows
from stockyard.operators.hierarchy import rooted
from stockyard.operators.positions import cume_dist, ntile, percent_rank, rank, with_ranks, with_running_sums


def hot_rows(n, seed):
    """A third of the rows share one value."""
    rng = random.Random(seed)
    return [(i, 5 if i % 3 == 0 else rng.randint(0, 9) if i % 7 else None) for i in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_sql_windows(spark, no_coalescing, descending):
    df = spark.createDataFrame(hot_rows(200, 1), "id long, value int").repartition(4)
    got = with_ranks(df, "value", ["id"], descending=descending).select(
        "id",
        rank().alias("r"),
        percent_rank(3).alias("p"),
        cume_dist(3).alias("c"),
        ntile(7).alias("t"),
        "position",
    )
    df.createOrReplaceTempView("ranked_values")
    order = "value desc nulls first" if descending else "value asc nulls last"
    want = spark.sql(
        f"""select id, cast(rank() over (order by {order}) as bigint) r,
                   cast(round(cast(percent_rank() over (order by {order}) as decimal(20,12)), 3) as decimal(24,3)) p,
                   cast(round(cast(cume_dist() over (order by {order}) as decimal(20,12)), 3) as decimal(24,3)) c, cast(ntile(7) over (order by {order}, id) as bigint) t,
                   cast(row_number() over (order by {order}, id) as bigint) position
            from ranked_values"""
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 9])
def test_ntile_of_few_rows(spark, rows):
    df = spark.createDataFrame([(i, i) for i in range(rows)], "id long, value int")
    got = [r.t for r in with_ranks(df, "value", ["id"]).select("id", ntile(4).alias("t")).orderBy("id").collect()]
    size, spare = divmod(rows, 4)
    want = [t for t in range(1, 5) for _ in range(size + (t <= spare))]
    assert got == want


def test_running_sums_across_slots(spark, no_coalescing):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 5}", i, rng.randint(-9, 9)) for i in range(150)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at int, x int").repartition(5)
    got = {(r.key, r.at): r.x_before for r in with_running_sums(df, ["key"], ["at"], ["x"]).collect()}
    want, sums = {}, {}
    for key, at, x in sorted(rows):
        want[(key, at)] = sums.get(key, 0)
        sums[key] = sums.get(key, 0) + x
    assert got == want


def brute_chains(events, steps):
    found, frontier = {}, [(e, 1) for e in events if e[3]]
    while frontier:
        grown = []
        for event, step in frontier:
            found[(event[0], step)] = found.get((event[0], step), 0) + 1
            if step < steps:
                grown += [(e, step + 1) for e in events if e[1] == event[1] and e[2] > event[2]]
        frontier = grown
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_equal_enumeration(spark, no_coalescing, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    events = [
        (i, "hot" if i % 3 else f"k{i % 4}", start + timedelta(hours=rng.randint(0, 12)), rng.random() < 0.4)
        for i in range(28)
    ]
    df = spark.createDataFrame(events, "id long, key string, at timestamp_ntz, starts boolean").repartition(3)
    rows = chain_rows(df, ["key"], "at", F.col("starts"), steps=5).collect()
    assert {(r.id, r.step): int(r.occurrences) for r in rows} == brute_chains(events, 5)


def test_chains_are_counted_once_but_for_the_ends_of_slots(spark):
    df = spark.createDataFrame([(1, "k", datetime(2024, 1, 1), True)], "id long, key string, at timestamp_ntz, starts boolean")
    plan = chain_reach(df, ["key"], "at", F.col("starts"), steps=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "_tail" in plan  # the second count of chains reads the first and the last key of a slot
    assert re.search(r"local_2#\d+L", plan)  # short chains as whole numbers


@pytest.mark.parametrize("most", [0, 9, 1000])
def test_chains_of_keys_placed_by_ranges_and_dealt_by_key(spark, no_coalescing, monkeypatch, most):
    monkeypatch.setattr(chains, "HOT_ROWS", most)  # all keys, one key, none by ranges
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    events = [(i, "hot" if i % 3 else f"k{i % 4}", start + timedelta(hours=rng.randint(0, 12)), rng.random() < 0.4) for i in range(28)]
    odd = [(90, None, start, True), (91, "hot", None, True), (92, "k1", start, None)]
    df = spark.createDataFrame(events + odd, "id long, key string, at timestamp_ntz, starts boolean").repartition(3)
    rows = chain_rows(df, ["key"], "at", F.col("starts"), steps=5).collect()
    known = [(91, "hot", datetime(1, 1, 1), True), odd[2], *events]  # without an instant: before all others
    want = {(i, step): n for (i, step), n in brute_chains(known, 5).items() if i != 91}
    assert {(r.id, r.step): int(r.occurrences) for r in rows} == want


def test_chains_take_one_shuffle_of_the_events(spark):
    df = spark.range(0, 8, 1, 2).selectExpr("id", "id % 2 as key", "id as at", "true as starts")
    plan = chain_rows(df, ["key"], "at", F.col("starts"), steps=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_repeat_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 25_000), (3, 10_000)], "id int, n int")
    counts = {r.id: r["count"] for r in repeat_rows(df, "n").groupBy("id").count().collect()}
    assert counts == {1: 3, 2: 25_000, 3: 10_000}


def test_trees(spark):
    edges = [(1, None, "r"), (2, 1, "a"), (3, 2, "b"), (4, 3, "c"), (5, 4, "d"), (6, 5, "e"), (10, None, "s")]
    edges += [(20, 99, "orphan"), (21, 20, "below"), (30, 31, "loop"), (31, 30, "loop"), (32, 31, "tail")]
    df = spark.createDataFrame(edges, "id long, up long, name string")
    rows = {r.id: (r.depth, r.full_path) for r in rooted(df, "id", "up", "name").collect()}
    assert rows == {
        1: (1, "r"),
        2: (2, "r > a"),
        3: (3, "r > a > b"),
        4: (4, "r > a > b > c"),
        5: (5, "r > a > b > c > d"),
        6: (6, "r > a > b > c > d > e"),
        10: (1, "s"),
    }

"""Every named query on the smallest supplied tables against its DuckDB text."""

import pytest
from compare import difference, duckdb_rows, open_duckdb, spark_rows

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"
QUERIES, CHECKS = contract.queries(), contract.oracle_sql()
OWN = set(contract.ENTRIES)


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(SMALL)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    actual = spark_rows(QUERIES[name](spark, SMALL))
    assert actual[1]
    if name in CHECKS:
        assert difference(duckdb_rows(duck, CHECKS[name]), actual) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["month", "revenue", "mom_growth_pct"]


def test_every_entry_has_a_check():
    assert OWN <= set(CHECKS)

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from stockyard.dataset import Dataset  # noqa: E402
from stockyard.schema import TABLES  # noqa: E402
from stockyard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Dataset from literal rows: ``make(as_of, sales_orders=[{...}, …])``; absent columns are NULL."""

    def build(as_of: datetime = datetime(2024, 6, 1), **tables) -> Dataset:
        frames = {name: rows_of(spark, name, tables.get(name, [])) for name in TABLES}
        return Dataset(spark, frames, as_of)

    return build


def rows_of(spark, name, rows):
    spec = TABLES[name]
    values = [tuple(row.get(c) for c in spec.column_names) for row in rows]
    return spark.createDataFrame(values, spec.schema)


@pytest.fixture(scope="module")
def no_coalescing(spark):
    """Keep several slots even for a few rows, so that keys and ties span them."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)

"""Calendar expressions. "Now" is always a literal handed in by the caller."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def day(as_of: datetime) -> Column:
    return F.lit(as_of.date())


def before(as_of: datetime, interval: str) -> Column:
    """The instant ``interval`` (for example ``90 DAYS``) before ``as_of``."""
    return instant(as_of) - F.expr(f"INTERVAL {interval}")


def month_of(date: str | Column) -> Column:
    return F.trunc(date, "MM")


def month_label(date: str | Column) -> Column:
    """A month's name, for example ``2023_01``."""
    return F.date_format(date, "yyyy_MM")


def year_of(date: str | Column) -> Column:
    return F.trunc(date, "YEAR")


def day_of_week(date: str | Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(date) - 1


def lead_days() -> Column:
    return F.datediff("actual_delivery_date", "order_date")

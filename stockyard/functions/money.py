"""Exact money arithmetic on line items.

Amounts stay decimal through every sum; a discount is applied as ``(100 - pct) * 0.01`` so no
division can round a line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _hundredth() -> Column:
    return F.lit("0.01").cast("decimal(3,2)")


def gross_amount() -> Column:
    """Line value before discount."""
    return F.col("quantity") * F.col("unit_price")


def sum_gross() -> Column:
    return F.sum(gross_amount())


def sum_net() -> Column:
    """Sum of line values after discount: summed as whole hundredths, scaled once."""
    return F.sum(gross_amount() * (F.lit(100) - F.col("discount_pct"))) * _hundredth()


def sum_discount() -> Column:
    """Sum of what discounts took off."""
    return F.sum(gross_amount() * F.col("discount_pct")) * _hundredth()


_SCALE = 6  # no amount of the model has more decimals


def _whole(value: Column) -> Column:
    """A whole number or decimal as a count of millionths, exactly."""
    millionths = value.cast(f"decimal(38,{_SCALE})") * F.lit(10**_SCALE).cast("decimal(7,0)")
    return millionths.cast("decimal(38,0)")


def quotient(part: Column, whole: Column, digits: int, times: int = 1) -> Column:
    """``times * part / whole`` rounded half away from zero, in whole-number arithmetic.

    For whole numbers and decimals. A zero ``whole`` is an error, as it is in SQL.
    """
    over, under = _whole(part), _whole(whole)
    doubled = F.abs(over) * F.lit(2 * times * 10**digits).cast("decimal(10,0)") + F.abs(under)
    size = F.call_function("div", doubled, F.abs(under) * F.lit(2).cast("decimal(1,0)"))
    signed = F.when((over < 0) != (under < 0), -size).otherwise(size)
    return signed.cast("decimal(20,0)") * F.lit(str(10.0**-digits)).cast(f"decimal({digits + 1},{digits})")


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half away from zero; NULL for a zero whole."""
    return quotient(part, F.nullif(whole, F.lit(0).cast("decimal(1,0)")), digits, 100)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Plain double quotient; a zero denominator is an error, as it is in SQL."""
    return numerator.cast("double") / denominator.cast("double")

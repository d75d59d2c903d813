"""Rounding rules.

Money is DECIMAL(18,2) and its sums are exact, so they do not depend on the order
in which partitions are merged. Averages and ratios take exact decimal sums, turn
them into DOUBLE, divide once and round by an explicit formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.schemas import MONEY


def money(value: Column) -> Column:
    return value.cast(MONEY)


def round_half_up(value: Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero, never giving a negative zero."""
    scale = F.lit(float(10**digits))
    steps = F.floor(F.abs(value) * scale + F.lit(0.5))
    return F.when(F.abs(value) * scale < 0.5, F.lit(0.0)).otherwise(
        F.signum(value) * steps / scale
    )


def average(total: Column, count: Column, digits: int) -> Column:
    """Mean from an exact sum and a count; NULL for a count of 0."""
    return round_half_up(
        F.try_divide(total.cast("double"), count.cast("double")), digits
    )


def ratio_pct(part: Column, whole: Column) -> Column:
    """Unrounded ``part * 100 / whole`` in DOUBLE; NULL where ``whole`` is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))

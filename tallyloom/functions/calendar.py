"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(value: Column, bad_dates: str = "raise") -> Column:
    """Text, timestamp or date to DATE; a bad date raises unless told to give NULL."""
    if bad_dates == "raise":
        return F.to_date(value)
    if bad_dates == "null":
        return F.try_to_date(value.cast("string"))
    raise ValueError("bad_dates must be 'raise' or 'null'")


def date_key(day: Column) -> Column:
    """The integer yyyymmdd of a date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)

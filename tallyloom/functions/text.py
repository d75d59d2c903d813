"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(value: Column) -> Column:
    """Remove all white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(
        F.regexp_replace(value, r"^[\s\p{Z}]+", ""), r"[\s\p{Z}]+$", ""
    )

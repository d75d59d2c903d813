"""Parameters that the reference hard-codes as literals."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class MartParams:
    """Calendar range, as-of date and growth years of one warehouse.

    The defaults are fixed values: they reproduce the published results.
    """

    date_start: date = date(2024, 1, 1)
    date_end: date = date(2025, 12, 31)
    asof: date = date(2026, 1, 1)
    growth_years: tuple[int, int] = (2024, 2025)

    @property
    def calendar_months(self) -> int:
        """Months the calendar touches; no cohort offset can reach this number."""
        return (
            (self.date_end.year - self.date_start.year) * 12
            + self.date_end.month
            - self.date_start.month
            + 1
        )

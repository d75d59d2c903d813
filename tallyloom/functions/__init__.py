from tallyloom.functions.calendar import date_key, parse_date
from tallyloom.functions.numbers import average, money, ratio_pct, round_half_up
from tallyloom.functions.text import strip

__all__ = [
    "average",
    "date_key",
    "money",
    "parse_date",
    "ratio_pct",
    "round_half_up",
    "strip",
]

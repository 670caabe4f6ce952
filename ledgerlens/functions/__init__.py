"""Column -> Column helpers built from Spark SQL functions only."""

from ledgerlens.functions.dates import (
    clock_seconds,
    combine_date_time,
    day_gap,
    hour_of_clock,
    is_weekend,
    parse_clock,
    parse_day,
)
from ledgerlens.functions.numbers import money_text, parse_money, percent, ratio_or_zero
from ledgerlens.functions.text import blank_to_null, is_blank, is_missing_text, null_tokens, strip

__all__ = [
    "blank_to_null",
    "clock_seconds",
    "combine_date_time",
    "day_gap",
    "hour_of_clock",
    "is_blank",
    "is_missing_text",
    "is_weekend",
    "money_text",
    "null_tokens",
    "parse_clock",
    "parse_day",
    "parse_money",
    "percent",
    "ratio_or_zero",
    "strip",
]

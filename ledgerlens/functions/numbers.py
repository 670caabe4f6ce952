from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_money(c: Column) -> Column:
    """Text to DECIMAL(18,2); text that is no plain number becomes NULL."""
    return c.try_cast("decimal(18,2)")


def money_text(c: Column) -> Column:
    """`16000` as `16,000.00`."""
    return F.format_number(c, 2)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, two decimals half-even, 0.0 of nothing."""
    return F.bround(ratio_or_zero(part, whole) * 100, 2)

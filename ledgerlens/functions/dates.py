from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
WITH_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d(\.\d+)?)?)?$"
CLOCK = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"


def parse_day(c: Column, with_time: bool = False) -> Column:
    """`yyyy-mm-dd` text (one-digit month or day allowed) to DATE, else NULL.

    The cast alone would also take years, months and timestamps. `with_time`
    allows a valid clock time behind the day, which is left out.
    """
    return F.when(c.rlike(WITH_TIME if with_time else DAY), c.try_cast("date"))


def parse_clock(c: Column) -> Column:
    """`h:m:s` text to canonical `HH:mm:ss` text, else NULL."""
    padded = F.concat_ws(":", *[F.lpad(F.split_part(c, F.lit(":"), F.lit(i)), 2, "0") for i in (1, 2, 3)])
    return F.when(c.rlike(CLOCK), F.when(F.length(c) == 8, c).otherwise(padded))


def hour_of_clock(c: Column) -> Column:
    return F.substring(c, 1, 2).try_cast("int")


def clock_seconds(c: Column) -> Column:
    """Seconds since midnight of `HH:mm:ss` text."""
    part = lambda at: F.substring(c, at, 2).try_cast("int")
    return part(1) * 3600 + part(4) * 60 + part(7)


def combine_date_time(day: Column, clock: Column) -> Column:
    """DATE and clock text as one timestamp; NULL when either is."""
    return F.concat(day.cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday by the SQL numbering (1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(day).isin(1, 7)


def day_gap(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)

"""Date and time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def span_micros(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end`` (negative when reversed).

    Subtracts the zone-free values themselves; ``timestamp_diff`` would pass them
    through the session time zone, where some local times do not exist.
    """
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def span_days(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return span_micros(start, end).cast("double") / F.lit(float(MICROS_PER_DAY))


def month_start(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment.cast("date"), "month")


def quarter_start(moment: Column) -> Column:
    """First day of the quarter, as a date."""
    return F.trunc(moment.cast("date"), "quarter")


def weekday_number(moment: Column) -> Column:
    """Day of week with Sunday as 0 and Saturday as 6."""
    return F.dayofweek(moment) - F.lit(1)


def day_name_padded(moment: Column) -> Column:
    """English day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(moment, "EEEE"), 9, " ")

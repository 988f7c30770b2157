"""Day-number dates and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day 0 of the SAS calendar.
SAS_EPOCH = "1960-01-01"
# Day numbers of 0001-01-01 and 9999-12-31.
FIRST_DAY = -715509
LAST_DAY = 2936549


def sas_to_date(days: Column, zero_is_null: bool = True) -> Column:
    """Days since 1960-01-01 as a date; fractions floor, NULL and NaN give NULL.

    Numbers that no date of the years 1 to 9999 has give NULL as well. Day 0 counts
    as "no date" unless ``zero_is_null`` is off.
    """
    number = days.cast("double")
    usable = (number >= FIRST_DAY) & (number < LAST_DAY + 1)  # false for NaN as well
    if zero_is_null:
        usable = usable & (number != 0)
    epoch = F.lit(SAS_EPOCH).cast("date")
    return F.when(usable, F.date_add(epoch, F.floor(number).cast("int")))


def sas_days(day: Column) -> Column:
    """A date as a SAS day number, the inverse of :func:`sas_to_date`."""
    return F.datediff(day.cast("date"), F.lit(SAS_EPOCH).cast("date")).cast("double")


def calendar_parts(day: Column, prefix: str = "arrival") -> dict[str, Column]:
    """Day, ISO week, month, calendar year, and weekday (1 is Sunday)."""
    return {
        f"{prefix}_day": F.dayofmonth(day),
        f"{prefix}_week": F.weekofyear(day),
        f"{prefix}_month": F.month(day),
        f"{prefix}_year": F.year(day),
        f"{prefix}_weekday": F.dayofweek(day),
    }

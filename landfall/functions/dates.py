"""Dates kept as a DOUBLE count of days since 1960-01-01."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1960-01-01"
# Day numbers of 0001-01-01 and 9999-12-31, the calendar a DATE can hold.
FIRST_DAY, LAST_DAY = -715509, 2936549


def whole_day(days: Column) -> Column:
    """The day number as INT, fractions floored; null for null, NaN and days outside the calendar."""
    days = days.cast("double")
    floored = F.floor(days)
    return F.when(~F.isnan(days) & floored.between(FIRST_DAY, LAST_DAY), floored.cast("int"))


def sas_date(days: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), whole_day(days))


def sas_day(days: Column) -> Column:
    """Day of month; null for a null day."""
    return F.dayofmonth(sas_date(days))


def day_number(date: Column) -> Column:
    """INT days from the epoch to a date, the inverse of :func:`sas_date`."""
    return F.datediff(date.cast("date"), F.lit(EPOCH).cast("date"))

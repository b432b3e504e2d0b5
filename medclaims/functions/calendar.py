"""Calendar expressions."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """A date as its YYYYMMDD integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_of_key(column: str) -> Column:
    """Year of a YYYYMMDD integer. ``floor`` of the quotient, also below zero."""
    return F.floor(F.col(column) / F.lit(10000)).cast("int")


def sunday_based_weekday(day: Column) -> Column:
    """Sunday 0 ... Saturday 6; Spark itself counts from Sunday 1."""
    return F.dayofweek(day) - 1


def month_start(day: Column) -> Column:
    """First day of the month, still a DATE."""
    return F.trunc(day, "MM")


def seconds_between(start: str, end: str) -> Column:
    """Second boundaries crossed, so fractions are cut off first."""
    return F.timestamp_diff(
        "SECOND", F.date_trunc("SECOND", F.col(start)), F.date_trunc("SECOND", F.col(end))
    )


def minutes_before(now: datetime, minutes: int) -> Column:
    """A point in time some minutes before ``now``."""
    return F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {minutes} minutes")

"""Sums, ratios and counts."""

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from medclaims.schemas import TOTAL


def null_safe_sum(columns: Iterable[str]) -> Column:
    """Sum over columns, NULL counting as zero."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def flag_count(columns: Iterable[str]) -> Column:
    """How many flags are 1; NULL counts as not set."""
    return reduce(add, [F.when(F.col(c) == 1, 1).otherwise(0) for c in columns])


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when dividing by zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals rounded half up, NULL for nothing."""
    return F.round(safe_ratio(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)")), 2)


def total(column: str) -> Column:
    """A5: exact decimal sum."""
    return F.sum(column).cast(TOTAL)


def mean_amount(column: str) -> Column:
    """A5: mean of a decimal column as a double, from the exact sum."""
    return safe_ratio(F.sum(column).cast("double"), F.count(column))

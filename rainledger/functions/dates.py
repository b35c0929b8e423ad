"""Calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of the two named seasons.
DRY_MONTHS = [6, 7, 8, 9]
WET_MONTHS = [12, 1, 2, 3]


def date_key(day: Column) -> Column:
    """Date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(day: Column) -> Column:
    """Full English month name (Spark's formatter does not follow the machine's locale)."""
    return F.date_format(day, "MMMM")


def season(day: Column) -> Column:
    month = F.month(day)
    return F.when(month.isin(DRY_MONTHS), "dry").when(month.isin(WET_MONTHS), "wet").otherwise("transition")


def full_days_between(start: Column, end: Column) -> Column:
    """Whole days elapsed between two zone-free timestamps, as bigint."""
    return F.extract(F.lit("DAY"), end - start).cast("bigint")

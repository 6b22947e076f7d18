"""UTC calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_day(moment: Column) -> Column:
    """The UTC date; the session zone is UTC."""
    return F.to_date(moment)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def iso_weekday(day: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(day) + 1


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")

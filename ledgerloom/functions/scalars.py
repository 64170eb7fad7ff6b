"""Scalar expressions whose Spark spelling is not the obvious one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_element(array: str | Column) -> Column:
    """Element 0, or null when the array is empty or null."""
    return F.get(array, 0)


def required_first_element(array: str | Column) -> Column:
    """Element 0; an empty array raises under ANSI mode."""
    return F.element_at(array, 1)


def from_epoch_millis(text: str | Column) -> Column:
    return F.timestamp_millis(_column(text).cast("long"))


def whole_hours(start: str | Column, end: str | Column) -> Column:
    """Elapsed hours from start to end, cut toward zero."""
    return F.timestamp_diff("HOUR", _column(start), _column(end))


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Elapsed 24-hour days from start to end, cut toward zero."""
    return F.timestamp_diff("DAY", _column(start), _column(end))


def calendar_days(start: str | Column, end: str | Column) -> Column:
    """Difference of the calendar dates, as a long."""
    return F.date_diff(F.to_date(end), F.to_date(start)).cast("long")


def divide_or_null(numerator: str | Column, denominator: str | Column) -> Column:
    """Floating division, null when the denominator is zero."""
    return F.try_divide(_column(numerator).cast("double"), _column(denominator).cast("double"))


def sunday_week(date: str | Column) -> Column:
    """Week of the year with weeks that begin on Sunday; days before the first are week 0."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("long")


def flag(condition: Column) -> Column:
    """true or false, never null."""
    return F.coalesce(condition, F.lit(False))


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reporting date: given, or today's."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c

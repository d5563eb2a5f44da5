"""Scalar date functions (all JVM-side built-ins, so they stay inside whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from circulation.constants import DAY_PATTERN, DAY_TEXT_LENGTH

DateLike = str | _dt.date | _dt.datetime


def day_of(text: Column | str, strict: bool = True) -> Column:
    """Calendar day of a ``YYYY-MM-DD...`` timestamp text: ``to_date(substring(s, 1, 10))``.

    ``strict`` raises on malformed text (the reference's load fails); otherwise NULL.
    """
    c = F.col(text) if isinstance(text, str) else text
    head = F.substring(c, 1, DAY_TEXT_LENGTH)
    return F.to_date(head, DAY_PATTERN) if strict else F.try_to_date(head, DAY_PATTERN)


def time_key(day: Column) -> Column:
    """Midnight timestamp of a date, the type of ``time_key`` columns."""
    return day.cast("timestamp_ntz")


def day_of_week_sunday0(c: Column) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday (Spark's ``dayofweek`` is 1 = Sunday)."""
    return (F.dayofweek(c) - 1).cast("int")


def date_parts(c: Column) -> list[Column]:
    """quarter_of_year, day_of_week, day, month, year of a date/timestamp column."""
    return [
        F.quarter(c).cast("int").alias("quarter_of_year"),
        day_of_week_sunday0(c).alias("day_of_week"),
        F.dayofmonth(c).cast("int").alias("day"),
        F.month(c).cast("int").alias("month"),
        F.year(c).cast("int").alias("year"),
    ]


def as_date(value: DateLike) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def as_midnight(value: DateLike) -> _dt.datetime:
    d = as_date(value)
    return _dt.datetime(d.year, d.month, d.day)


def midnight_lit(value: DateLike) -> Column:
    """A bound TIMESTAMP_NTZ literal at midnight of ``value``."""
    return F.lit(as_midnight(value)).cast("timestamp_ntz")

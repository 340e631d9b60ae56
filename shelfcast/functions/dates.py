"""Calendar expressions of one date column."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(col: Column) -> Column:
    """Text or timestamp to a date, null where it does not parse."""
    return F.to_date(F.try_to_timestamp(col.cast("string")))


def day_of_week(date: Column) -> Column:
    """Monday 0 .. Sunday 6."""
    return F.weekday(date)


def is_weekend(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def week_of_month(date: Column) -> Column:
    return (F.floor((F.dayofmonth(date) - 1) / 7) + 1).cast("int")


def start_of_month(date: Column, days: int = 3) -> Column:
    return (F.dayofmonth(date) <= days).cast("int")


def end_of_month(date: Column, days: int = 3) -> Column:
    return (F.dayofmonth(date) > F.dayofmonth(F.last_day(date)) - days).cast("int")


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of ``period`` steps."""
    angle = position.cast("double") * F.lit(2 * pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)

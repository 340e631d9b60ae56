"""Forecast error expressions for one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.numeric import ratio


def absolute(real: Column, forecast: Column) -> Column:
    return F.abs(forecast - real)


def squared(real: Column, forecast: Column) -> Column:
    return (forecast - real) * (forecast - real)


def percentage(real: Column, forecast: Column) -> Column:
    """Absolute error in percent of the actual value; null where that is 0."""
    return ratio(F.abs(forecast - real), F.abs(real)) * F.lit(100.0)


def symmetric_percentage(real: Column, forecast: Column) -> Column:
    """Absolute error in percent of the mean magnitude; null where both are 0."""
    return ratio(F.abs(forecast - real), (F.abs(real) + F.abs(forecast)) / F.lit(2.0)) * F.lit(100.0)

"""Forecast scores: pooled, by any key, as the mean of daily errors, and the naive floor."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import errors

MEASURES = ("mae", "rmse", "mape", "smape")


def score_columns(real: Column, forecast: Column) -> list[Column]:
    """The four scores as aggregates; rows without a forecast or actual are skipped."""
    return [
        F.avg(errors.absolute(real, forecast)).alias("mae"),
        F.sqrt(F.avg(errors.squared(real, forecast))).alias("rmse"),
        F.avg(errors.percentage(real, forecast)).alias("mape"),
        F.avg(errors.symmetric_percentage(real, forecast)).alias("smape"),
    ]


def pooled_metrics(predictions: DataFrame, by: Iterable[str] = ("model",)) -> DataFrame:
    """MAE, RMSE, MAPE and SMAPE over all rows of each group.

    MAPE leaves out days with an actual of 0, SMAPE days where both are 0; a group
    with nothing left has null.
    """
    return predictions.groupBy(*by).agg(*score_columns(F.col("real"), F.col("forecast")), F.count(F.lit(1)).alias("n"))


def daily_errors(predictions: DataFrame) -> DataFrame:
    """The errors of each day; the daily RMSE is the absolute error by definition."""
    real, forecast = F.col("real"), F.col("forecast")
    return predictions.withColumns(
        {
            "mae": errors.absolute(real, forecast),
            "rmse": F.sqrt(errors.squared(real, forecast)),
            "mape": errors.percentage(real, forecast),
            "smape": errors.symmetric_percentage(real, forecast),
        }
    )


def mean_of_daily_metrics(predictions: DataFrame, by: Iterable[str] = ("model",)) -> DataFrame:
    """Averages of ``daily_errors``: its ``rmse`` equals its ``mae``."""
    return daily_errors(predictions).groupBy(*by).agg(*[F.avg(m).alias(m) for m in MEASURES])


def last_month_metrics(predictions: DataFrame, by: Iterable[str] = ("model", "barcode")) -> DataFrame:
    """Pooled scores of the last month that each group has predictions for."""
    by = list(by)
    month = F.trunc("date", "month")
    group = Window.partitionBy(*by)
    monthly = (
        predictions.withColumn("month", month)
        .groupBy(*by, "month")
        .agg(*score_columns(F.col("real"), F.col("forecast")), F.count(F.lit(1)).alias("n"))
        .withColumn("_last", F.max("month").over(group))
    )
    return monthly.where(F.col("month") == F.col("_last")).drop("_last")


METRICS = {"pooled": pooled_metrics, "mean_of_daily": mean_of_daily_metrics, "last_month": last_month_metrics}


def naive_baseline(train: DataFrame, series: str = "barcode", target: str = "quantity") -> DataFrame:
    """MAE of "same as the row before" for each series."""
    order = Window.partitionBy(series).orderBy("date")
    return (
        train.select(series, F.abs(F.col(target) - F.lag(target, 1).over(order)).alias("e"))
        .groupBy(series)
        .agg(F.avg("e").alias("naive_mae"), F.count("e").alias("n"))
    )


def metrics_by_window(test: DataFrame, by: Iterable[str] = ("barcode", "window_id")) -> DataFrame:
    """Scores of the test rows of each window (``real``, ``forecast``)."""
    return pooled_metrics(test, by)

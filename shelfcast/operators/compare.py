"""Side-by-side results of several models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import errors
from shelfcast.operators.metrics import MEASURES, pooled_metrics

# Accepted names of a forecast column, in order of preference.
FORECAST_NAMES = ("forecast", "prediction_{model}", "prediction", "predicted", "yhat")
ACTUAL_NAMES = ("Quantity", "real")


def _pick(df: DataFrame, names: Iterable[str], what: str) -> str:
    names = list(names)
    by_lower = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in by_lower:
            return by_lower[name.lower()]
    raise ValueError(f"no {what} column in {df.columns}; expected one of {names}")


def harmonise(df: DataFrame, model: str, series: str = "barcode") -> DataFrame:
    """Any model's output as ``model, barcode, date, real, forecast``."""
    forecast = _pick(df, [n.format(model=model) for n in FORECAST_NAMES], "forecast")
    actual = _pick(df, ACTUAL_NAMES, "actual")
    return df.select(
        F.lit(model).alias("model"),
        F.col(series),
        F.col(_pick(df, ["date"], "date")).cast("date").alias("date"),
        F.col(actual).cast("double").alias("real"),
        F.col(forecast).cast("double").alias("forecast"),
    )


def stack_models(results: Mapping[str, DataFrame], series: str = "barcode") -> DataFrame:
    """One long table of the predictions of all models."""
    if not results:
        raise ValueError("no predictions to compare")
    return reduce(DataFrame.unionByName, [harmonise(df, m, series) for m, df in results.items()])


def merge_models(predictions: DataFrame, models: Iterable[str], series: str = "barcode") -> DataFrame:
    """One row per series and day with a column per model.

    Days that only some models predict are kept, and the actual is taken from
    whichever model has it. One aggregation replaces a chain of full outer joins.
    """
    return predictions.groupBy(series, "date").agg(
        F.max("real").alias("real"),
        *[F.max(F.when(F.col("model") == m, F.col("forecast"))).alias(m) for m in models],
    )


def compared_errors(merged: DataFrame, models: Iterable[str]) -> DataFrame:
    """Daily errors of each model as ``mae_<model>`` and so on, with year and month."""
    columns = {"year": F.year("date"), "month": F.month("date")}
    real = F.col("real")
    for m in models:
        f = F.col(m)
        columns |= {
            f"mae_{m}": errors.absolute(real, f),
            f"rmse_{m}": F.sqrt(errors.squared(real, f)),
            f"mape_{m}": errors.percentage(real, f),
            f"smape_{m}": errors.symmetric_percentage(real, f),
        }
    return merged.withColumns(columns)


def annual_summary(merged: DataFrame, models: Iterable[str], series: str = "barcode") -> DataFrame:
    """Yearly totals of the actual and of each model; nothing counts as 0."""
    return merged.groupBy(series, F.year("date").alias("year")).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("real", *models)]
    )


def chart_series(merged: DataFrame, models: Iterable[str], series: str = "barcode") -> DataFrame:
    """Lines of the monthly charts: one row per series, day and line."""
    lines = ["real", *models]
    return (
        merged.select(series, F.year("date").alias("year"), F.month("date").alias("month"), "date", *lines)
        .unpivot([series, "year", "month", "date"], lines, "series_name", "value")
        .where(F.col("value").isNotNull())
    )


def long_predictions(merged: DataFrame, models: Iterable[str], series: str = "barcode") -> DataFrame:
    """A merged table back in one row per model and day; days that a model does not predict have none."""
    models = list(models)
    return (
        merged.select(series, "date", "real", *models)
        .unpivot([series, "date", "real"], models, "model", "forecast")
        .where(F.col("forecast").isNotNull())
    )


def compare_merged(merged: DataFrame, models: Iterable[str], series: str = "barcode") -> dict[str, DataFrame]:
    """Everything that is kept of a comparison: scores, predictions, yearly sums, daily errors."""
    models = list(models)
    return {
        "metrics": pooled_metrics(long_predictions(merged, models, series), [series, "model"]).select(series, "model", *MEASURES),
        "predictions": merged,
        "annual": annual_summary(merged, models, series),
        "daily": compared_errors(merged, models),
        "charts": chart_series(merged, models, series),
    }


def compare(predictions: DataFrame, models: Iterable[str], series: str = "barcode") -> dict[str, DataFrame]:
    """``compare_merged`` of long predictions."""
    models = list(models)
    return compare_merged(merge_models(predictions, models, series), models, series)

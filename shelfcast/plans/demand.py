"""From sale lines to model inputs and simple forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import calendar, features, folds, rollup
from shelfcast.sources.star import END, SPLIT, START, YEAR, Store

# Models with a closed form: the value of the day before and the mean of the last seven days.
CLOSED_FORM = {"naive": "lag_1", "mean7": "rolling_mean_7"}


def daily(
    store: Store, start: str = START, end: str = END, wanted: DataFrame | None = None, split_hot: bool = False
) -> DataFrame:
    """Daily totals; ``split_hot`` for stores where one product's day has more prices than a task should sort."""
    return rollup.daily_sales(store.lines, store.sales, store.products, start, end, wanted, split_hot)


def merged(store: Store, start: str = START, end: str = END, wanted: DataFrame | None = None) -> DataFrame:
    return rollup.merge_duplicate_days(daily(store, start, end, wanted))


def dense(store: Store, start: str = START, end: str = END, wanted: DataFrame | None = None) -> DataFrame:
    """Gap-free series of all wanted products, without holidays."""
    products = store.products if wanted is None else store.products.join(
        wanted.select("product_code").distinct(), "product_code", "left_semi"
    )
    return calendar.fill_calendar(merged(store, start, end, wanted), start, end, wanted=products)


def with_holidays(series: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Flags from a holiday table, or from the national rules, with the local days set."""
    flagged = calendar.flag_rules(series) if holidays is None else calendar.flag_holidays(series, holidays)
    return calendar.override_holidays(flagged)


def model_inputs(store: Store, start: str = START, end: str = END, drop_incomplete: bool = True) -> DataFrame:
    """Features of all products; the eve flag is not a model input."""
    series = with_holidays(dense(store, start, end)).drop("holiday_eve", "product_code")
    return features.build_features(series, drop_incomplete=drop_incomplete)


def closed_form_predictions(inputs: DataFrame, year: int = YEAR) -> DataFrame:
    """The closed-form forecasts of the forecast year as a long prediction table."""
    return (
        inputs.where(F.year("date") == year)
        .select("barcode", "date", F.col("quantity").alias("real"), *[F.col(c).alias(m) for m, c in CLOSED_FORM.items()])
        .unpivot(["barcode", "date", "real"], list(CLOSED_FORM), "model", "forecast")
        .select("model", "barcode", "date", "real", "forecast")
    )


def closed_form_backtest(inputs: DataFrame, fold: folds.Fold, split: str = SPLIT) -> DataFrame:
    """The closed-form forecasts of the test rows of every window before ``split``."""
    train = inputs.where(F.col("date") < F.lit(split).cast("date"))
    forecasts = [F.col(c).alias(m) for m, c in CLOSED_FORM.items()]
    rows = train.select("barcode", "date", F.col("quantity").alias("real"), *forecasts)
    return folds.test_rows(rows, fold).drop("position")

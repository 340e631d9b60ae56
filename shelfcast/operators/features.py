"""Model inputs of a gap-free daily series."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.functions.numeric import ratio
from shelfcast.schemas import LAGS

SMALL = 1e-5
WEEK = 7

Step = Callable[[DataFrame], DataFrame]


def calendar_features(df: DataFrame) -> DataFrame:
    date = F.col("date")
    dow, month = dates.day_of_week(date), F.month(date)
    dow_sin, dow_cos = dates.cycle(dow, 7)
    m_sin, m_cos = dates.cycle(month - 1, 12)
    return df.withColumns(
        {
            "day_of_week": dow,
            "month": month,
            "is_weekend": dates.is_weekend(date),
            "day_of_year": F.dayofyear(date),
            "week_of_year": F.weekofyear(date),
            "start_month": dates.start_of_month(date),
            "end_month": dates.end_of_month(date),
            "dow_sin": dow_sin,
            "dow_cos": dow_cos,
            "m_sin": m_sin,
            "m_cos": m_cos,
        }
    )


def history_features(df: DataFrame, series: str = "barcode", lags: Iterable[int] = LAGS) -> DataFrame:
    """Lags and the mean and deviation of the seven days before.

    All expressions share one window, hence one sort and one window operator.
    """
    order = Window.partitionBy(series).orderBy("date")
    before = order.rowsBetween(-WEEK, -1)
    full = F.count("quantity").over(before) == WEEK
    columns = {f"lag_{n}": F.lag("quantity", n).over(order) for n in lags}
    columns |= {
        "rolling_mean_7": F.when(full, F.avg("quantity").over(before)),
        "rolling_std_7": F.when(full, F.stddev_samp("quantity").over(before)),
        "promo_lag_1": F.lag("on_promotion", 1).over(order).cast("double"),
        "_returned_lag_1": F.lag("returned_quantity", 1).over(order),
    }
    if "holiday" in df.columns:
        columns["holiday_lag_1"] = F.coalesce(F.lag("holiday", 1).over(order), F.lit(0))
    return df.withColumns(columns)


def rate_features(df: DataFrame) -> DataFrame:
    """Discount, increase, return and margin rates; needs ``history_features``."""
    price, small = F.col("unit_value"), F.lit(SMALL)
    return df.withColumns(
        {
            "discount_rate": ratio(F.col("discount"), price + F.col("discount")),
            "increase_rate": ratio(F.col("increase"), price + small),
            "returned_rate": ratio(F.col("_returned_lag_1"), F.col("lag_1") + small),
            "profit_margin": ratio(price - F.col("cost_value"), price + small),
        }
    ).drop("_returned_lag_1")


def build_features(
    dense: DataFrame, series: str = "barcode", extra: Iterable[Step] = (), drop_incomplete: bool = True
) -> DataFrame:
    """All model inputs; ``extra`` steps are applied before incomplete rows go.

    ``total_value`` is left out because it contains the target. The calendar comes
    last, so that the window sorts and buffers narrow rows.
    """
    df = (
        dense.drop("total_value")
        .transform(history_features, series)
        .transform(rate_features)
        .transform(calendar_features)
    )
    for step in extra:
        df = df.transform(step)
    return complete_rows(df) if drop_incomplete else df


def is_complete(df: DataFrame) -> Column:
    """Whether a row has no null or NaN in any column.

    One condition per column: a single "no nulls in all of these" predicate makes
    the optimizer derive a variant for every combination of renamed columns.
    """
    complete = F.lit(True)
    for f in df.schema:
        complete = complete & F.col(f.name).isNotNull()
        if f.dataType.typeName() in ("double", "float"):
            complete = complete & ~F.isnan(f.name)
    return complete


def complete_rows(df: DataFrame) -> DataFrame:
    return df.where(is_complete(df))


def rows_per_series(all_rows: DataFrame, series: str = "barcode") -> DataFrame:
    """Days and complete rows of each series, from features with incomplete rows kept.

    A product that never sold has no usable row: its discount rate is undefined.
    """
    return all_rows.groupBy(series).agg(
        F.count(F.lit(1)).alias("days"), F.count_if(is_complete(all_rows)).alias("complete_rows")
    )

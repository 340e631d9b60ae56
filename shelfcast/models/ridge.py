"""Linear models, one per product.

Spark scales the inputs and brings each series, at most one calendar long, to one
task; numpy solves the normal equations there. The penalty is chosen on the last
fifth of the train rows, which takes the place of early stopping.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import clip_low
from shelfcast.operators import scaling
from shelfcast.operators.folds import Fold
from shelfcast.schemas import FEATURES
from shelfcast.session import by_key

# Workers get these helpers with the task, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PENALTIES = (1.0, 10.0, 100.0, 1000.0)
TRAIN_SHARE = 0.8
STEPS = 7
CELLS = 1 << 20  # of the normal equations that a task holds at a time, per penalty


def scaled_inputs(
    inputs: DataFrame, split: str, columns: Iterable[str] = FEATURES, series: str = "barcode"
) -> DataFrame:
    """``series, date, quantity`` and the scaled columns, statistics from before ``split``.

    The statistics cover all train rows, also those after a backtest window. That
    look-ahead is part of the published procedure and is kept.
    """
    columns = list(columns)
    before = F.col("date") < F.lit(split).cast("date")
    return scaling.scale(inputs.select(series, "date", "quantity", *columns), columns, before, series)


def with_intercept(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def solve(gram: np.ndarray, moment: np.ndarray, penalty: float) -> np.ndarray:
    """Coefficients; the last one, the intercept, is not penalised."""
    ridge = np.full(len(gram), penalty)
    ridge[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(ridge), moment)


def fit(x: np.ndarray, y: np.ndarray, penalties: Sequence[float] = PENALTIES) -> tuple[np.ndarray, float]:
    """Coefficients from the first 80 percent of the rows, penalty by MAE on the rest."""
    cut = int(len(x) * TRAIN_SHARE)
    betas, chosen = fit_windows(x, y, np.zeros(1, int), cut, len(x), penalties)
    return betas[0], chosen[0]


def window_sums(x: np.ndarray, y: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``X'X`` and ``X'y`` of the rows ``start .. start + size`` of each start.

    Rows are multiplied once per block between two window borders, and a window is
    the difference of two running sums of blocks.
    """
    both = np.hstack([x, y[:, None]])
    edges = np.unique(np.concatenate([starts, starts + size]))
    sums = np.zeros((len(edges), both.shape[1], both.shape[1]))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        np.matmul(both[a:b].T, both[a:b], out=sums[i + 1])
        sums[i + 1] += sums[i]
    windows = sums[np.searchsorted(edges, starts + size)] - sums[np.searchsorted(edges, starts)]
    return windows[:, :-1, :-1], windows[:, :-1, -1]


def fit_windows(
    x: np.ndarray, y: np.ndarray, starts: np.ndarray, cut: int, stop: int, penalties: Sequence[float] = PENALTIES
) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of each window from its first ``cut`` rows, and the penalty with the lowest MAE up to row ``stop``.

    The first of equal penalties is taken, also where no row is left to tell them apart.
    """
    grams, moments = window_sums(x, y, starts, cut)
    size, count = x.shape[1], len(penalties)
    ridges = np.zeros((count, size, size))
    ridges[:, range(size), range(size)] = np.array(penalties, float)[:, None]
    ridges[:, -1, -1] = 1e-9
    right = np.broadcast_to(moments[:, None, :, None], (len(starts), count, size, 1))
    betas = np.linalg.solve(grams[:, None] + ridges, right)[..., 0]
    best = np.zeros(len(starts), int)
    if stop > cut:
        rows = starts[:, None] + np.arange(cut, stop)
        off = betas @ x[rows].transpose(0, 2, 1) - y[rows][:, None]
        best = np.abs(off).mean(axis=2).argmin(axis=1)
    return betas[np.arange(len(starts)), best], np.array(penalties, float)[best]


def steps_before(x: np.ndarray, steps: int) -> np.ndarray:
    """Row ``i`` holds rows ``i .. i + steps - 1`` of ``x`` side by side, for target ``i + steps``."""
    count = max(0, len(x) - steps)
    if not count:
        return np.empty((0, steps * x.shape[1]))
    return np.hstack([x[k : k + count] for k in range(steps)])


def _backtest(inputs, split, fold, columns, series, sequence_steps, clip, penalties=PENALTIES):
    columns = list(columns)
    scaled = scaled_inputs(inputs, split, columns, series).where(F.col("date") < F.lit(split).cast("date"))

    # Plain numbers, so that the task carries no class of this package.
    train, length, step, lead = fold.train, fold.length, fold.step, sequence_steps
    cut = int((train - lead) * TRAIN_SHARE)

    def windows(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        x, y = pdf[columns].to_numpy(float), pdf["quantity"].to_numpy(float)
        # Row i of z holds the inputs of target i + lead. A window's first targets go, so that no
        # sequence reaches over the border between train and test part.
        z, y = with_intercept(steps_before(x, lead) if lead else x), y[lead:]
        rows, ids, forecasts, chosen = [], [], [], []
        count = (len(x) - length) // step + 1 if len(x) >= length and train > lead and length > train + lead else 0
        many = max(1, CELLS // z.shape[1] ** 2)  # windows whose equations are held at a time
        for low in range(0, count, many):
            window = np.arange(low, min(low + many, count))
            first = window[0] * step
            part = slice(first, window[-1] * step + length)
            betas, best = fit_windows(z[part], y[part], window * step - first, cut, train - lead, penalties)
            test = window[:, None] * step + np.arange(train, length - lead)
            rows.append((test + lead).ravel())
            ids.append(np.repeat(window, test.shape[1]))
            forecasts.append((z[test] @ betas[:, :, None])[..., 0].ravel())
            chosen.append(np.repeat(best, test.shape[1]))
        index = np.concatenate(rows) if rows else np.empty(0, int)
        test = pdf[[series, "date", "quantity"]].iloc[index].reset_index(drop=True)
        return pd.DataFrame(
            {
                series: test[series],
                "window_id": np.concatenate(ids) if ids else [],
                "date": test["date"],
                "real": test["quantity"],
                "forecast": np.concatenate(forecasts) if forecasts else [],
                "penalty": np.concatenate(chosen) if chosen else [],
            }
        )

    schema = f"{series} string, window_id int, date date, real double, forecast double, penalty double"
    result = by_key(scaled, series).groupBy(series).applyInPandas(windows, schema)
    return result.withColumn("forecast", clip_low(F.col("forecast"))) if clip else result


def backtest(
    inputs: DataFrame,
    split: str,
    fold: Fold = Fold(365, 7, 7),
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
    clip: bool = True,
    penalties: Iterable[float] = PENALTIES,
) -> DataFrame:
    """A model per product and window on the same day's inputs.

    A series is sent once and cut into its windows in the task, instead of being
    copied once per window before the shuffle. The windows' normal equations slide:
    each row is multiplied once, not once for each of the many windows that hold it.
    """
    return _backtest(inputs, split, fold, columns, series, 0, clip, tuple(penalties))


def backtest_sequence(
    inputs: DataFrame,
    split: str,
    fold: Fold = Fold(365, STEPS + 1, 7),
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
    steps: int = STEPS,
    clip: bool = False,
) -> DataFrame:
    """As ``backtest`` on the rows of the seven days before; one test row per window."""
    return _backtest(inputs, split, fold, columns, series, steps, clip)


def forecast_sequence(
    inputs: DataFrame,
    split: str,
    year: int,
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
    steps: int = STEPS,
    clip: bool = False,
) -> DataFrame:
    """Walk through the forecast year month by month, one model per product.

    The model is fitted on all rows before ``split``. After each month is forecast,
    its rows are added to the normal equations, which is the exact update of a
    linear model. A forecast uses the seven rows before its day, never its own.
    """
    columns = list(columns)
    cut = pd.Timestamp(split)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        names = [series, "date", "real", "forecast"]
        days = pd.to_datetime(pdf["date"])
        x = with_intercept(steps_before(pdf[columns].to_numpy(float), steps))
        y, days, keys = pdf["quantity"].to_numpy(float)[steps:], days.iloc[steps:], pdf[series].iloc[steps:]
        known = (days < cut).to_numpy()
        if not known.any():
            return pd.DataFrame(columns=names)
        penalty = fit(x[known], y[known])[1]
        gram, moment = x[known].T @ x[known], x[known].T @ y[known]
        out = []
        for month in range(1, 13):
            now = ((days.dt.year == year) & (days.dt.month == month)).to_numpy()
            if not now.any():
                continue
            forecast = x[now] @ solve(gram, moment, penalty)
            out.append(pd.DataFrame({series: keys[now], "date": days[now].dt.date, "real": y[now], "forecast": forecast}))
            gram, moment = gram + x[now].T @ x[now], moment + x[now].T @ y[now]
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    wanted = (F.col("date") < F.lit(split).cast("date")) | (F.year("date") == year)
    rows = scaled_inputs(inputs, split, columns, series).where(wanted)
    result = by_key(rows, series).groupBy(series).applyInPandas(walk, f"{series} string, date date, real double, forecast double")
    forecast = clip_low(F.col("forecast")) if clip else F.col("forecast")
    return result.na.drop(subset=["forecast"]).select(F.lit("sequence").alias("model"), series, "date", "real", forecast.alias("forecast"))

"""Features, windows, splits, scaling and leakage on small frames."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features, folds, scaling

START = dt.date(2024, 1, 1)


def series(spark, quantities, barcode="a", **columns):
    n = len(quantities)
    rows = [
        (
            barcode,
            START + dt.timedelta(i),
            float(q),
            columns.get("price", [9.0] * n)[i],
            columns.get("cost", [6.0] * n)[i],
            columns.get("promo", [0] * n)[i],
            columns.get("returned", [0.0] * n)[i],
            columns.get("discount", [1.0] * n)[i],
            0.0,
            columns.get("holiday", [0] * n)[i],
            1.0,
        )
        for i, q in enumerate(quantities)
    ]
    names = (
        "barcode string, date date, quantity double, unit_value double, cost_value double, on_promotion int, "
        "returned_quantity double, discount double, increase double, holiday int, total_value double"
    )
    return spark.createDataFrame(rows, names)


def test_calendar_features(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 12, 30), dt.date(2024, 2, 27), dt.date(2024, 2, 26)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r.date: r for r in features.calendar_features(df).collect()}
    first = got[days[0]]
    assert (first.day_of_week, first.week_of_year, first.day_of_year, first.start_month) == (0, 1, 1, 1)
    assert got[days[1]].week_of_year == 1
    assert (got[days[2]].end_month, got[days[3]].end_month) == (1, 0)
    assert first.m_sin == 0 and first.m_cos == 1 and first.dow_cos == 1
    assert got[days[3]].dow_sin == pytest.approx(math.sin(0.0))


def test_lags_and_rolling(spark):
    df = series(spark, range(1, 10), promo=[1] + [0] * 8, holiday=[1] + [0] * 8)
    rows = features.history_features(df).orderBy("date").collect()
    assert (rows[7].lag_1, rows[7].lag_7, rows[7].rolling_mean_7) == (7.0, 1.0, 4.0)
    assert rows[7].rolling_std_7 == pytest.approx(2.160247, abs=1e-6)
    assert rows[6].rolling_mean_7 is None and rows[6].rolling_std_7 is None
    assert (rows[0].holiday_lag_1, rows[1].holiday_lag_1) == (0, 1)
    assert (rows[0].promo_lag_1, rows[1].promo_lag_1) == (None, 1.0)


def test_rates(spark):
    rows = features.build_features(series(spark, [4, 2], returned=[2.0, 0.0]), drop_incomplete=False).orderBy("date").collect()
    r = rows[1]
    assert (r.discount_rate, r.increase_rate) == (0.1, 0.0)
    assert r.profit_margin == pytest.approx(3 / 9.00001)
    assert r.returned_rate == pytest.approx(2 / 4.00001)
    assert "total_value" not in rows[0].asDict()


def test_incomplete_rows_go(spark):
    assert features.build_features(series(spark, range(31))).count() == 1
    free = series(spark, range(31), price=[0.0] * 31, discount=[0.0] * 31)
    assert features.build_features(free).count() == 0
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "x"), (None, "x"), (2.0, None)], "a double, b string")
    assert [tuple(r) for r in features.complete_rows(df).collect()] == [(1.0, "x")]


def test_extra_steps_are_applied(spark):
    df = features.build_features(series(spark, range(31)), extra=[lambda d: d.withColumn("double_lag", F.col("lag_1") * 2)])
    assert df.first().double_lag == 58.0


def brute_windows(n, fold):
    start, out = 0, []
    while start + fold.length <= n:
        out.append((start, start + fold.train, start + fold.length))
        start += fold.step
    return out


@pytest.mark.parametrize("n, fold", [(10, folds.Fold(4, 2, 3)), (5, folds.Fold(4, 2, 3)), (40, folds.Fold(10, 7, 4)), (20, folds.Fold(3, 2, 5))])
def test_windows_match_the_loop(spark, n, fold):
    df = series(spark, range(n)).select("barcode", "date", "quantity")
    expected = brute_windows(n, fold)
    rows = folds.rolling_windows(df, fold).collect()
    for w, (a, b, c) in enumerate(expected):
        train = sorted(r.quantity for r in rows if r.window_id == w and r.role == "train")
        test = sorted(r.quantity for r in rows if r.window_id == w and r.role == "test")
        assert (train, test) == ([float(i) for i in range(a, b)], [float(i) for i in range(b, c)])
    assert len(rows) == len(expected) * fold.length
    tests = {(r.window_id, r.quantity) for r in folds.test_rows(df, fold).collect()}
    assert tests == {(w, float(i)) for w, (a, b, c) in enumerate(expected) for i in range(b, c)}
    bounds = {r.window_id: r for r in folds.window_bounds(df, fold).collect()}
    assert set(bounds) == set(range(len(expected)))
    for w, (a, b, c) in enumerate(expected):
        days = [START + dt.timedelta(i) for i in (a, b - 1, b, c - 1)]
        assert [bounds[w].train_start, bounds[w].train_end, bounds[w].test_start, bounds[w].test_end] == days


def test_full_size_window_count(spark):
    df = spark.range(1796).select(F.lit("a").alias("barcode"), F.expr("date_add(date'2019-01-31', cast(id as int))").alias("date"))
    assert folds.window_bounds(df, folds.Fold(365, 7, 7)).count() == 204


def test_validation_split(spark):
    got = folds.validation_split(series(spark, range(365)).select("barcode", "date"))
    assert got.where("not is_validation").count() == 292
    assert got.where("not is_validation").agg(F.max("date")).first()[0] == START + dt.timedelta(291)


def test_sequences_hold_the_rows_before(spark):
    rows = folds.sequences(series(spark, range(10)), ["quantity"]).orderBy("date").collect()
    assert [r.target for r in rows] == [7.0, 8.0, 9.0]
    assert rows[0].sequence == [[float(i)] for i in range(7)]


def test_scaler(spark):
    df = series(spark, [2, 4, 6], price=[5.0, 5.0, 5.0])
    stats = {r.feature: r for r in scaling.scaler_stats(df, ["quantity", "unit_value"]).collect()}
    assert stats["quantity"].mean == 4 and stats["quantity"].std == pytest.approx(1.632993, abs=1e-6)
    assert (stats["unit_value"].mean, stats["unit_value"].std) == (5, 1)
    scaled = scaling.scale(df, ["unit_value"], F.lit(True)).collect()
    assert {r.unit_value for r in scaled} == {0.0}


@pytest.mark.parametrize("fold", [folds.Fold(9, 3, 4), folds.Fold(8, 2, 4), folds.Fold(5, 2, 7)])
def test_leakage_matches_numpy(spark, fold):
    rng = np.random.default_rng(1)
    q = rng.integers(0, 50, 40).astype(float)
    df = series(spark, q.tolist(), price=(q * 2 + 1.0).tolist(), cost=[3.0] * 40, discount=rng.random(40).tolist())
    got = {
        (r.window_id, r.feature): r
        for r in scaling.leakage_correlations(df, ["unit_value", "cost_value", "discount"], fold).collect()
    }
    disc = np.array([r.discount for r in df.orderBy("date").collect()])
    windows = brute_windows(40, fold)
    assert len(got) == 3 * len(windows)
    for w, (a, b, _) in enumerate(windows):
        assert got[w, "unit_value"].corr == pytest.approx(1.0) and got[w, "unit_value"].suspicious == 1
        assert got[w, "cost_value"].corr is None and got[w, "cost_value"].suspicious == 0
        assert got[w, "discount"].corr == pytest.approx(np.corrcoef(disc[a:b], q[a:b])[0, 1])

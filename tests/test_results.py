"""Scores, comparison, inventory and product choice."""

import datetime as dt
import inspect

import pytest

from shelfcast.operators import compare, inventory, lookup, metrics
from shelfcast.sources import database


def days(n, start=dt.date(2024, 1, 1)):
    return [start + dt.timedelta(i) for i in range(n)]


def predictions(spark, rows):
    return spark.createDataFrame(rows, "model string, barcode string, date date, real double, forecast double")


def sample(spark, forecast=(1.0, 8.0, 25.0)):
    return predictions(spark, [("m", "a", d, r, f) for d, r, f in zip(days(3), (0.0, 10.0, 20.0), forecast)])


def test_pooled(spark):
    r = metrics.pooled_metrics(sample(spark)).first()
    assert [r.mae, r.rmse, r.mape, r.smape] == pytest.approx([2.666667, 3.162278, 22.5, 81.481481], abs=1e-6)
    perfect = metrics.pooled_metrics(sample(spark, (0.0, 10.0, 20.0))).first()
    assert (perfect.mae, perfect.rmse, perfect.mape, perfect.smape) == (0, 0, 0, 0)


def test_nothing_left_is_null(spark):
    r = metrics.pooled_metrics(predictions(spark, [("m", "a", days(1)[0], 0.0, 0.0)])).first()
    assert (r.mae, r.mape, r.smape) == (0, None, None)


def test_daily_and_their_mean(spark):
    rows = metrics.daily_errors(sample(spark)).orderBy("date").collect()
    assert [r.mae for r in rows] == [1, 2, 5] == [r.rmse for r in rows]
    assert [r.mape for r in rows] == [None, 20, 25]
    assert [r.smape for r in rows] == pytest.approx([200, 22.222222, 22.222222], abs=1e-6)
    mean = metrics.METRICS["mean_of_daily"](sample(spark)).first()
    assert mean.rmse == mean.mae == pytest.approx(8 / 3)


def test_last_month(spark):
    rows = [("m", "a", dt.date(2024, 1, 5), 1.0, 9.0), ("m", "a", dt.date(2024, 2, 5), 1.0, 2.0)]
    got = metrics.METRICS["last_month"](predictions(spark, rows)).collect()
    assert [(r.month, r.mae) for r in got] == [(dt.date(2024, 2, 1), 1.0)]


def test_naive(spark):
    df = spark.createDataFrame([("a", d, q) for d, q in zip(days(3), (3.0, 5.0, 4.0))], "barcode string, date date, quantity double")
    assert metrics.naive_baseline(df).first().naive_mae == 1.5


def test_merge_keeps_all_days(spark):
    d = days(3)
    both = predictions(
        spark, [("x", "a", d[0], 1.0, 2.0), ("x", "a", d[1], 3.0, 4.0), ("y", "a", d[1], 3.0, 5.0), ("y", "a", d[2], 7.0, 8.0)]
    )
    merged = compare.merge_models(both, ["x", "y"])
    rows = merged.orderBy("date").collect()
    assert [(r.real, r.x, r.y) for r in rows] == [(1, 2, None), (3, 4, 5), (7, None, 8)]
    year = compare.annual_summary(merged, ["x", "y"]).first()
    assert (year.year, year.real, year.x, year.y) == (2024, 11, 6, 13)
    assert compare.chart_series(merged, ["x", "y"]).count() == 7
    assert set(compare.compare(both, ["x", "y"])) == {"metrics", "predictions", "annual", "daily", "charts"}


@pytest.mark.parametrize("name", ["forecast", "prediction_m", "prediction", "predicted", "yhat", "YHAT"])
def test_forecast_column_names(spark, name):
    df = spark.createDataFrame([("a", days(1)[0], 1.0, 2.0)], f"barcode string, Date date, Quantity double, {name} double")
    r = compare.stack_models({"m": df}).first()
    assert (r.model, r.barcode, r.date, r.real, r.forecast) == ("m", "a", days(1)[0], 1.0, 2.0)


def test_unknown_forecast_column(spark):
    df = spark.createDataFrame([("a", days(1)[0], 1.0)], "barcode string, date date, real double")
    with pytest.raises(ValueError, match="forecast"):
        compare.harmonise(df, "m")


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "barcode string")


def test_coverage_and_report(spark):
    months = lambda b, ms: [(b, 2024, m) for m in ms]
    schema = "barcode string, year int, month int"
    full = spark.createDataFrame(months("a", range(1, 13)) + months("b", [*range(1, 11), 12]), schema)
    charts = spark.createDataFrame(months("a", range(1, 13)) + months("b", range(1, 13)), schema)
    got = inventory.month_coverage(names(spark, "a", "b", "c"), full, charts, 2024)
    rows = {r.barcode: r for r in got.collect()}
    assert rows["a"].complete == 1
    assert (rows["b"].complete, rows["b"].missing_predictions, rows["b"].missing_charts) == (0, "11", "")
    assert rows["c"].missing_charts.startswith("01, 02, 03")
    lines = {r.barcode: r.line for r in inventory.report_lines(got).collect()}
    assert lines["a"] == "- a" and lines["b"] == "Product b: predictions missing for months: 11"


def test_sets(spark):
    got = inventory.reconcile(names(spark, "b", "d"), names(spark, "a", "b"), names(spark, "b", "c"))
    assert {(r.barcode, r.difference) for r in got.collect()} == {
        ("d", "listed_not_found"),
        ("a", "found_not_listed"),
        ("c", "found_not_listed"),
    }
    raw, moved = names(spark, "a", "b"), names(spark, "c")
    predicted, charted = names(spark, "a", "c", "d", "e"), names(spark, "a", "c", "d")
    status = inventory.inventory_status(raw, moved, predicted, charted)
    assert {tuple(r) for r in status.collect()} == {("a", "can_move"), ("c", "already_moved"), ("d", "only_processed")}
    r = inventory.inventory_counts(raw, moved, predicted, charted).first()
    assert (r.total_raw, r.total_moved, r.total_processed) == (2, 1, 3)
    assert (r.can_move, r.already_moved, r.only_processed, r.remaining) == (1, 1, 1, 1)
    assert [r.barcode for r in inventory.missing_predictions(raw, predicted).collect()] == ["b"]


def test_products(spark):
    products = spark.createDataFrame([(1, "7000001"), (2, "2000002"), (3, "70003"), (4, "7000004")], "product_code bigint, barcode string")
    scores = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, 9.0), (4, 1.0)], "product_code bigint, score double")
    assert [r.product_code for r in lookup.top_products(scores, products, 5).collect()] == [1, 4]
    assert [r.product_code for r in lookup.top_products(scores, products, 1).collect()] == [1]
    lines = spark.createDataFrame([(5, "a"), (3, "a"), (8, None)], "product_code bigint, barcode string")
    found = lookup.resolve_barcodes(names(spark, "a", "x", "a"), lines)
    assert {tuple(r) for r in found.collect()} == {("a", 3), ("x", None)}
    assert [r.barcode for r in lookup.unresolved(found).collect()] == ["x"]


def test_sequential_codes(spark):
    df = spark.createDataFrame([(c,) for c in (2222, 1111, 1111, 5, 99999)], "product_code bigint")
    assert {tuple(r) for r in lookup.sequential_codes(df).collect()} == {(5, 1), (1111, 2), (2222, 3), (99999, 4)}
    assert sorted(r.product_code for r in lookup.anonymise_codes(df).collect()) == [1, 2, 2, 3, 4]
    assert {tuple(r) for r in lookup.numbered(spark, [30, 10]).collect()} == {(30, 1), (10, 2)}


def test_database_columns(spark):
    df = spark.createDataFrame([(7, dt.datetime(2024, 1, 1))], "codigo bigint, data timestamp_ntz")
    assert database.sales(df).first().sale_id == 7
    with pytest.raises(ValueError, match="lower"):
        database.read_table(spark, "jdbc:none", "t", split_on="id")
    assert "partitions" in inspect.signature(database.read_table).parameters

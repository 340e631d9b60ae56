"""Files in and out, the stream of new files, models and the forecast plan."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.models import boosted, ridge
from shelfcast.operators import calendar
from shelfcast.operators.folds import Fold
from shelfcast.plans import forecast
from shelfcast.schemas import EXPORT_COLUMNS, FEATURES
from shelfcast.session import scratch_path
from shelfcast.sinks import models, tables, versions
from shelfcast.sources import files, predictions
from shelfcast.streaming import intake

HEADER = ",".join(EXPORT_COLUMNS.values())


def write_product(folder, barcode, rows=3, prefix="produto_"):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"2024-01-{i + 1:02d},{barcode},0,{i}.0,0.0,0.0,0.0,1.0,2.0,1.0,0" for i in range(rows)]
    (folder / f"{prefix}{barcode}.csv").write_text("\n".join([HEADER, *lines]) + "\n")


def test_product_folder(spark, tmp_path):
    write_product(tmp_path, "0789")
    write_product(tmp_path, "55", prefix="")
    write_product(tmp_path / "deeper", "66")
    with open(tmp_path / "produto_0789.csv", "a") as f:
        f.write("not a date,0789,x\n")
    good, bad = files.read_series(spark, str(tmp_path))
    assert {(r.barcode, r.date.day, r.quantity) for r in good.collect()} == {("0789", i + 1, float(i)) for i in range(3)}
    assert [r.barcode for r in bad.collect()] == ["0789"]
    good, _ = files.read_series(spark, str(tmp_path), only_product_files=False)
    assert {r.barcode for r in good.collect()} == {"0789", "55"}
    assert {r.barcode for r in files.barcodes_in_folder(spark, str(tmp_path)).collect()} == {"0789"}
    assert {r.barcode for r in files.barcodes_in_folder(spark, str(tmp_path), recursive=True).collect()} == {"0789", "66"}


def test_barcode_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" 1 \n\n2\n1\n   \n")
    assert {r.barcode for r in files.read_barcode_list(spark, str(tmp_path / "list.txt")).collect()} == {"1", "2"}


def test_series_round_trip_and_patch(spark, tmp_path):
    write_product(tmp_path / "in", "7")
    write_product(tmp_path / "in", "8")
    good, _ = files.read_series(spark, str(tmp_path / "in"))
    dense = good.withColumn("product_code", F.lit(1))
    out = str(tmp_path / "out")
    tables.write_series(dense, out, "m1")
    back = files.read_written_series(spark, out)
    assert back.count() == 6 and back.where("product = '7'").count() == 3
    assert {r.market for r in back.collect()} == {"m1"}
    assert len(list((tmp_path / "out" / "market=m1" / "product=7").glob("*.csv"))) == 1
    shared = str(tmp_path / "shared")
    tables.write_series(dense, shared, "m1", per_product=False)
    assert sorted(map(tuple, files.read_written_series(spark, shared).select(*back.columns).collect())) == sorted(map(tuple, back.collect()))
    tables.write_consolidated(dense, str(tmp_path / "all"), single_file=True)
    assert len(list((tmp_path / "all").glob("*.csv"))) == 1
    october = back.withColumn("Date", F.lit(dt.date(2024, 10, 18)))
    tables.patch_series(october, str(tmp_path / "patched"), fmt="parquet")
    assert {r.Holiday for r in spark.read.parquet(str(tmp_path / "patched")).collect()} == {1}
    assert calendar.overridden_rows(october, date="Date").first()[0] == 6


def frame(spark, model, months, forecast_value=1.0):
    rows = [(model, b, dt.date(2024, m, d), 2.0, forecast_value) for m in months for d in (1, 2) for b in ("a", "b")]
    return spark.createDataFrame(rows, "model string, barcode string, date date, real double, forecast double")


def test_predictions_are_replaced_by_month(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_predictions(frame(spark, "x", [1, 2]), path)
    tables.write_predictions(frame(spark, "y", [1]), path)
    tables.write_predictions(frame(spark, "x", [2], 5.0), path)
    x = predictions.read_predictions(spark, path, "x")
    assert {(r.date.month, r.forecast) for r in x.collect()} == {(1, 1.0), (2, 5.0)}
    assert x.count() == 8 and predictions.read_predictions(spark, path).count() == 12
    assert predictions.predicted_months(spark, path, "x").count() == 4
    tables.write_predictions(frame(spark, "x", [3]), path, reset=True)
    assert {r.date.month for r in predictions.read_predictions(spark, path, "x").collect()} == {3}
    assert predictions.read_predictions(spark, path, "y").count() == 4


def test_reports(spark, tmp_path):
    lines = spark.createDataFrame([(1, "b", "second"), (0, "a", "first")], "section int, barcode string, line string")
    tables.write_report(lines, str(tmp_path / "r"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["first", "second"]
    diff = spark.createDataFrame([("2", "x"), ("1", "x"), ("3", "y")], "barcode string, difference string")
    tables.write_differences(diff, str(tmp_path / "d"))
    assert [r.value for r in spark.read.text(str(tmp_path / "d" / "difference=x")).collect()] == ["1", "2"]


def test_stream_takes_each_file_once(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    write_product(raw, "1")
    write_product(raw, "other", prefix="x_")
    intake.append_available(intake.new_series(spark, str(raw)), out, ckpt)
    assert spark.read.parquet(out).count() == 3
    intake.append_available(intake.new_series(spark, str(raw)), out, ckpt)
    assert spark.read.parquet(out).count() == 3
    write_product(raw, "2", rows=2)
    intake.append_available(intake.new_series(spark, str(raw)), out, ckpt)
    assert {(r.barcode, r["count"]) for r in spark.read.parquet(out).groupBy("barcode").count().collect()} == {("1", 3), ("2", 2)}


def test_stream_runs_a_step_per_batch(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    for b in "123":
        write_product(raw, b)
    step = lambda df: df.groupBy("barcode").agg(F.sum("quantity").alias("q"))
    intake.process_available(intake.new_series(spark, str(raw), files_per_batch=1), out, ckpt, step)
    rows = spark.read.parquet(out).collect()
    assert {(r.barcode, r.q) for r in rows} == {("1", 3.0), ("2", 3.0), ("3", 3.0)}
    assert {r.batch for r in rows} == {0, 1, 2}


@pytest.fixture(scope="module")
def inputs(spark):
    """Two products with a weekly pattern that the inputs explain, 2022 to 2024."""
    rng = np.random.default_rng(7)
    frames = []
    for barcode, level in (("a", 10.0), ("b", 100.0)):
        date = pd.date_range("2022-01-01", "2024-12-31")
        pdf = pd.DataFrame(rng.random((len(date), len(FEATURES))), columns=list(FEATURES))
        pdf["day_of_week"] = date.dayofweek
        pdf["is_weekend"] = (date.dayofweek >= 5).astype(float)
        pdf["quantity"] = level * (1 + pdf["is_weekend"]) + rng.random(len(date))
        pdf.insert(0, "barcode", barcode)
        pdf.insert(1, "date", date.date)
        frames.append(pdf)
    path = scratch_path(spark, "inputs")
    spark.createDataFrame(pd.concat(frames)).write.parquet(path)
    return spark.read.parquet(path)


def test_ridge_backtest(spark, inputs):
    fold = Fold(200, 7, 50)
    got = ridge.backtest(inputs, "2024-01-01", fold).toPandas()
    windows = (730 - 207) // 50 + 1
    assert got.groupby("barcode").size().to_dict() == {"a": windows * 7, "b": windows * 7}
    assert (got.forecast >= 0).all()
    assert (got.forecast - got.real).abs().mean() < 6.0
    # The same by brute force for one window.
    pdf = ridge.scaled_inputs(inputs, "2024-01-01").where("barcode = 'a' and date < '2024-01-01'").toPandas().sort_values("date")
    x, y = pdf[list(FEATURES)].to_numpy(), pdf["quantity"].to_numpy()
    x = np.hstack([x, np.ones((len(x), 1))])[100:307]
    y = y[100:307]
    best = None
    for penalty in ridge.PENALTIES:
        p = np.diag([penalty] * len(FEATURES) + [1e-9])
        beta = np.linalg.inv(x[:160].T @ x[:160] + p) @ x[:160].T @ y[:160]
        loss = np.abs(x[160:200] @ beta - y[160:200]).mean()
        if best is None or loss < best[0]:
            best = loss, beta
    one = got[(got.barcode == "a") & (got.window_id == 2)].sort_values("date")
    assert one.forecast.to_numpy() == pytest.approx(np.maximum(x[200:] @ best[1], 0))


def test_sequence_backtest_has_one_row_per_window(spark, inputs):
    got = ridge.backtest_sequence(inputs, "2024-01-01", Fold(100, 8, 100)).toPandas()
    assert got.groupby("barcode").size().tolist() == [7, 7]
    assert ridge.backtest_sequence(inputs, "2024-01-01", Fold(100, 7, 100)).count() == 0


def test_sequence_forecast_does_not_look_ahead(spark, inputs):
    plain = ridge.forecast_sequence(inputs, "2024-01-01", 2024).toPandas().sort_values(["barcode", "date"])
    assert len(plain) == 2 * 366
    late = F.col("date") >= F.lit("2024-07-01").cast("date")
    changed = inputs.withColumns({"quantity": F.when(late, 1e4).otherwise(F.col("quantity")), "lag_1": F.when(late, 0.0).otherwise(F.col("lag_1"))})
    other = ridge.forecast_sequence(changed, "2024-01-01", 2024).toPandas().sort_values(["barcode", "date"])
    early = pd.to_datetime(plain.date).to_numpy() <= np.datetime64("2024-07-01")
    assert plain.forecast[early].to_numpy() == pytest.approx(other.forecast[early].to_numpy())


def test_forecast_plan(spark, inputs, tmp_path):
    settings = boosted.Settings(rounds=3, rate=0.5, update_rounds=1)
    plan = forecast.Plan(str(tmp_path / "p"), "2024-01-01", 2024, str(tmp_path / "c"), str(tmp_path / "m"), settings)
    both = {"boosted": forecast.ModelOptions(), "sequence": forecast.ModelOptions()}
    first = forecast.run(spark, inputs, plan, both)
    got = first["boosted"].toPandas()
    assert len(got) == 2 * 366 and (got.forecast >= 0).all()
    naive = inputs.where("year(date) = 2024").toPandas().groupby("barcode").quantity.apply(lambda q: q.diff().abs().mean()).mean()
    assert (got.forecast - got.real).abs().mean() < naive
    assert versions.read_version(spark, plan.comparison, "metrics").count() == 4
    assert versions.read_version(spark, plan.comparison, "daily").select("year", "month").distinct().count() == 12
    reuse = {n: forecast.ModelOptions(forecast.REUSE) for n in both}
    assert forecast.run(spark, None, plan, reuse)["sequence"].count() == 2 * 366
    with pytest.raises(ValueError, match="no inputs"):
        forecast.run(spark, None, plan, both)
    assert forecast.run(spark, None, plan, {"boosted": forecast.ModelOptions(forecast.SKIP)}) == {}
    # The saved model is found again, unless the inputs have other names.
    assert models.load_model(spark, FEATURES, f"{tmp_path}/m/boosted") is not None
    assert models.load_model(spark, FEATURES[1:], f"{tmp_path}/m/boosted") is None
    assert models.load_model(spark, FEATURES, f"{tmp_path}/none") is None


def test_unknown_mode():
    with pytest.raises(ValueError, match="mode"):
        forecast.ModelOptions("later")


def test_new_files_are_forecast_once(spark, tmp_path):
    raw, args = tmp_path / "raw", (str(tmp_path / "out"), str(tmp_path / "ckpt"), "2024-01-01", 2024)
    raw.mkdir()

    def product(barcode):
        rng = np.random.default_rng(int(barcode))
        days = pd.date_range("2023-06-01", "2024-02-10").date
        rows = [f"{d},{barcode},0,{rng.integers(0, 9)}.0,0.0,0.5,0.0,1.0,{rng.integers(2, 5)}.0,1.0,0" for d in days]
        (raw / f"produto_{barcode}.csv").write_text("\n".join([HEADER, *rows]) + "\n")

    product("1")
    forecast.forecast_new_files(spark, str(raw), *args)
    product("2")
    forecast.forecast_new_files(spark, str(raw), *args)
    got = spark.read.parquet(args[0]).groupBy("barcode").agg(F.count(F.lit(1)).alias("n"), F.max("batch").alias("batch"))
    assert {tuple(r) for r in got.collect()} == {("1", 41, 0), ("2", 41, 1)}


def test_columns_are_found_by_the_header(spark, tmp_path):
    write_product(tmp_path, "1")
    names = HEADER.split(",")
    swapped = ["Holiday", *names[:-1]]
    (tmp_path / "produto_2.csv").write_text(",".join(swapped) + "\n0,2024-01-01,2,1,5.0,0.5,0.1,0.2,10.0,2.0,1.0\n0,bad,2,1,5,0,0,0,1,1,1\n0,2024-01-02,2,1,five,0,0,0,1,1,1\n")
    (tmp_path / "produto_3.csv").write_text("2024-01-01,3,0,1,0,0,0,1,2,1,0\n")
    good, bad = files.read_series(spark, str(tmp_path))
    row = good.where("barcode = '2'").collect()
    assert [(r.date.day, r.on_promotion, r.quantity, r.returned_quantity, r.holiday) for r in row] == [(1, 1, 5.0, 0.5, 0)]
    assert sorted(r.barcode for r in bad.collect()) == ["2", "2", "3"]
    assert good.where("barcode = '1'").count() == 3
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    intake.append_available(intake.new_series(spark, str(tmp_path)), out, ckpt)
    assert sorted(map(tuple, spark.read.parquet(out).select(*good.columns).collect())) == sorted(map(tuple, good.collect()))
    intake.append_available(intake.new_series(spark, str(tmp_path), rejects=True), out + "-bad", ckpt + "-bad")
    assert sorted(r.barcode for r in spark.read.parquet(out + "-bad").collect()) == ["2", "2", "3"]

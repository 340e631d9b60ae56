"""Boosting with patience and a gate, sliding fits, readers of any width, versions, rejects and split reads."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import rejects
from shelfcast.models import boosted, ridge
from shelfcast.operators import folds, lookup, scaling
from shelfcast.operators.folds import Fold
from shelfcast.plans import forecast, queries
from shelfcast.schemas import EXPORT_COLUMNS
from shelfcast.session import scratch_path
from shelfcast.sinks import models, tables, versions
from shelfcast.sources import database, files, star
from shelfcast.streaming import intake

COLUMNS = ["x0", "x1", "x2"]
HEADER = list(EXPORT_COLUMNS.values())


# ------------------------------------------------------------------- boosting


def series_inputs(spark, months_shift=None, barcodes="ab", years=(2022, 2024), seed=3):
    """Daily rows whose quantity follows the inputs; ``months_shift`` adds a level from a month of 2024 on."""
    rng = np.random.default_rng(seed)
    frames = []
    for i, barcode in enumerate(barcodes):
        days = pd.date_range(f"{years[0]}-01-01", f"{years[1]}-12-31")
        pdf = pd.DataFrame(rng.random((len(days), 3)), columns=COLUMNS)
        pdf["quantity"] = (i + 1) * 10 * (1 + pdf.x0 + np.sin(6 * pdf.x1) + 0.2 * rng.random(len(days)))
        if months_shift:
            pdf.loc[days >= f"2024-{months_shift:02d}-01", "quantity"] += 15 * (i + 1)
        pdf.insert(0, "barcode", barcode)
        pdf.insert(1, "date", days.date)
        frames.append(pdf)
    path = scratch_path(spark, "inputs")
    spark.createDataFrame(pd.concat(frames)).write.parquet(path)
    return spark.read.parquet(path)


def test_a_later_better_round_is_found(spark):
    rng = np.random.default_rng(1)
    x = rng.random((1200, 3))
    y = np.sin(6 * x[:, 0]) + x[:, 1] + 0.2 * rng.standard_normal(1200)
    pdf = pd.DataFrame(x, columns=COLUMNS).assign(z_quantity=y, is_validation=rng.random(1200) < 0.3)
    rows = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(spark.createDataFrame(pdf)).repartition(2)
    path = scratch_path(spark, "train")
    rows.select("features", "z_quantity", "is_validation").write.parquet(path)
    train = spark.read.parquet(path)
    settings = boosted.Settings(patience=8, block=16, rate=0.1)
    model, errors = boosted.fit_trees(train, settings)
    best = int(np.argmin(errors)) + 1
    assert model.getNumTrees == best > 16  # beyond the first block
    assert len(errors) - best >= 8  # it went on until eight rounds brought nothing
    assert any(b > a for a, b in zip(errors, errors[1:best]))  # some round before the best one was worse than the one before
    # The shortened model is the ensemble of its first trees.
    got = model.evaluateEachIteration(train.where("is_validation"), "absolute")
    assert got == pytest.approx(errors[:best])
    built_in = GBTRegressor(labelCol="z_quantity", maxIter=100, stepSize=0.1, validationIndicatorCol="is_validation", validationTol=0.0, seed=42, maxDepth=5)
    assert built_in.fit(train).getNumTrees < best
    path = scratch_path(spark, "model")
    model.write().save(path)
    assert type(model).load(path).getNumTrees == best


def test_walk_forward_takes_what_helps(spark):
    inputs = series_inputs(spark, months_shift=3, years=(2023, 2024)).where("date < '2024-07-01'")
    settings = boosted.Settings(rounds=10, block=10, rate=0.2, update_rounds=2)
    panel = boosted.panel_rows(inputs, "2024-01-01", 2024, COLUMNS)
    base = boosted.fit_base(panel, "2024-01-01", settings, COLUMNS)
    plain = boosted.forecast(panel, base, 2024).toPandas()
    walked, state = boosted.walk_forward(panel, base, 2024, settings)
    got = walked.toPandas()
    assert len(got) == len(plain) == 2 * 182
    mae = lambda df: (df.forecast - df.real).abs().mean()
    assert state.updates and mae(got) < 0.7 * mae(plain)
    # What was forecast before a month's rows were learnt stays as it was.
    early = lambda df: df[pd.to_datetime(df.date).dt.month == 1].sort_values(["barcode", "date"]).forecast.to_numpy()
    assert early(got) == pytest.approx(early(plain))
    # The state that is returned is the one that forecast the last month, and its own update if that was taken.
    june = lambda df: df[pd.to_datetime(df.date).dt.month == 6].sort_values(["barcode", "date"]).forecast.to_numpy()
    scores = [boosted.Boosted(base, updates).score(panel.where("year(date) = 2024")) for updates in (state.updates, state.updates[:-1])]
    again = [june(boosted._unscaled(s, "m", "barcode", True).toPandas()) for s in scores]
    assert any(a == pytest.approx(june(got)) for a in again)


def test_walk_forward_refuses_what_does_not_help(spark):
    inputs = series_inputs(spark, years=(2023, 2024)).where("date < '2024-06-01'")
    settings = boosted.Settings(rounds=15, block=15, rate=0.2, update_rounds=1, update_weights=(1.0,))
    panel = boosted.panel_rows(inputs, "2024-01-01", 2024, COLUMNS)
    base = boosted.fit_base(panel, "2024-01-01", settings, COLUMNS)
    plain = boosted.forecast(panel, base, 2024).toPandas()
    got, state = boosted.walk_forward(panel, base, 2024, settings)
    got = got.toPandas()
    assert (got.forecast - got.real).abs().mean() <= (plain.forecast - plain.real).abs().mean() * 1.02
    assert len(state.updates) < 5
    with pytest.raises(ValueError, match="no rows"):
        boosted.walk_forward(panel, base, 2031, settings)


def test_saved_model_scores_by_its_own_statistics(spark, tmp_path):
    settings, path = boosted.Settings(rounds=5, block=5), str(tmp_path / "m")
    inputs = series_inputs(spark)
    panel, base = boosted.fit_or_load(spark, inputs, "2024-01-01", 2024, path, settings, COLUMNS)
    first = boosted.forecast(panel, base, 2024).toPandas().sort_values(["barcode", "date"])
    # Other train rows now, and a product that the model has not seen.
    later = series_inputs(spark, barcodes="abc", seed=9).where("date < '2024-01-01'").unionByName(inputs.where("year(date) = 2024"))
    later = later.unionByName(series_inputs(spark, barcodes="c").where("year(date) = 2024").withColumn("barcode", F.lit("c")))
    panel, loaded = boosted.fit_or_load(spark, later, "2024-01-01", 2024, path, settings, COLUMNS)
    again = boosted.forecast(panel, loaded, 2024).toPandas().sort_values(["barcode", "date"])
    assert list(again.barcode.unique()) == ["a", "b"]
    assert again.forecast.to_numpy() == pytest.approx(first.forecast.to_numpy(), abs=1e-12)
    saved = models.load_model(spark, COLUMNS, path)
    left_out = boosted.panel_parts(later, "2024-01-01", 2024, COLUMNS, stats=saved.stats)[1]
    assert {(r.barcode, r.reject_reason) for r in left_out.collect()} == {("c", boosted.NO_TRAIN)}
    assert models.load_model(spark, COLUMNS[::-1], path) is None


# ----------------------------------------------------------------- linear fits


@pytest.mark.parametrize("starts, size", [(range(0, 1400, 7), 292), ([0, 5, 9, 30], 4), ([0, 100], 3), ([0], 7), ([], 5), (range(0, 90, 30), 20)])
def test_window_sums(starts, size):
    rng = np.random.default_rng(2)
    x, y = ridge.with_intercept(1000 * rng.normal(size=(1796, 6))), rng.normal(size=1796)
    grams, moments = ridge.window_sums(x, y, np.array(starts, int), size)
    assert len(grams) == len(moments) == len(list(starts))
    for s, gram, moment in zip(starts, grams, moments):
        assert np.allclose(gram, x[s : s + size].T @ x[s : s + size], rtol=1e-10, atol=1e-6)
        assert np.allclose(moment, x[s : s + size].T @ y[s : s + size], rtol=1e-10, atol=1e-6)


def brute_backtest(x, y, fold, lead):
    """One fit per window from its own rows."""
    out = []
    for w, start in enumerate(range(0, len(x) - fold.length + 1, fold.step)):
        middle, stop = start + fold.train, start + fold.length
        xa, ya, xb = x[start:middle], y[start:middle], x[middle:stop]
        if lead:
            xa, ya, xb = ridge.steps_before(xa, lead), ya[lead:], ridge.steps_before(xb, lead)
        xa, xb, cut = ridge.with_intercept(xa), ridge.with_intercept(xb), int(len(xa) * 0.8)
        best = None
        for p in ridge.PENALTIES:
            beta = ridge.solve(xa[:cut].T @ xa[:cut], xa[:cut].T @ ya[:cut], p)
            loss = np.abs(xa[cut:] @ beta - ya[cut:]).mean()
            if best is None or loss < best[0]:
                best = loss, beta
        out += [(w, middle + lead + i, f) for i, f in enumerate(xb @ best[1])]
    return out


@pytest.mark.parametrize("lead, fold", [(0, Fold(200, 7, 7)), (7, Fold(150, 10, 7)), (0, Fold(90, 31, 30)), (7, Fold(100, 8, 60))])
def test_backtest_is_that_of_each_window(spark, lead, fold):
    inputs = series_inputs(spark, barcodes="a", years=(2022, 2023))
    run = ridge.backtest_sequence if lead else ridge.backtest
    got = run(inputs, "2024-01-01", fold, COLUMNS, clip=False).toPandas().sort_values(["window_id", "date"])
    pdf = ridge.scaled_inputs(inputs, "2024-01-01", COLUMNS).toPandas().sort_values("date").reset_index(drop=True)
    want = brute_backtest(pdf[COLUMNS].to_numpy(), pdf.quantity.to_numpy(), fold, lead)
    assert got.window_id.tolist() == [w for w, _, _ in want]
    assert got.date.tolist() == [pdf.date[i] for _, i, _ in want]
    assert got.forecast.to_numpy() == pytest.approx(np.array([f for _, _, f in want]), abs=1e-6)


# ------------------------------------------------------------ windows and scores


def dates(n):
    return [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(n)]


def test_split_inside_windows(spark):
    df = spark.createDataFrame([("a", d) for d in dates(30)] + [("b", d) for d in dates(9)], "barcode string, date date")
    fold, day = Fold(10, 2, 5), dates(40)
    rows = sorted(map(tuple, folds.split_bounds(df, fold).collect()))
    assert rows == [("a", w, day[5 * w], day[5 * w + 7], day[5 * w + 8], day[5 * w + 9], 8, 2) for w in range(4)]
    whole = folds.split_bounds(df, fold, share=1.0).first()
    assert (whole.validation_start, whole.validation_rows, whole.fit_rows) == (None, 0, 10)
    none = folds.split_bounds(df, fold, share=0.0).first()
    assert (none.fit_start, none.fit_end, none.validation_start) == (None, None, day[0])
    got = {(r.window_id, r.position) for r in folds.window_validation_rows(df, fold).collect()}
    assert got == {(w, 5 * w + i) for w in range(4) for i in (8, 9)}


def test_scaler_by_window(spark):
    rng = np.random.default_rng(4)
    values = 1e6 + rng.random(40)
    rows = [("a", d, float(v), 3.0, None if i % 5 == 0 else float(i)) for i, (d, v) in enumerate(zip(dates(40), values))]
    df = spark.createDataFrame(rows, "barcode string, date date, x double, flat double, holes double")
    for fold in (Fold(10, 2, 5), Fold(12, 3, 5), Fold(4, 2, 7)):
        got = {(r.window_id, r.feature): (r["mean"], r["std"]) for r in scaling.scaler_by_window(df, ["x", "flat", "holes"], fold).collect()}
        count = (40 - fold.length) // fold.step + 1
        assert len(got) == 3 * count
        for w in range(count):
            part = slice(w * fold.step, w * fold.step + fold.train)
            assert got[w, "x"] == pytest.approx((values[part].mean(), values[part].std()), rel=1e-6)
            assert got[w, "flat"] == (3.0, 1.0)
            known = [r[4] for r in rows[part] if r[4] is not None]
            assert got[w, "holes"] == pytest.approx((np.mean(known), np.std(known) or 1.0))
    fold = Fold(10, 2, 5)
    scaled = scaling.scaled_test_rows(df, ["x"], fold, keep=["x", "flat"]).collect()
    assert len(scaled) == 2 * 6 and scaled[0].flat == 3.0
    for r in scaled:
        part = values[5 * r.window_id : 5 * r.window_id + 10]
        assert r.x == pytest.approx((r.raw_x - part.mean()) / part.std(), rel=1e-5)


# ---------------------------------------------------------------------- readers


def wide_file(folder, barcode, rows=2, extra=30, lack=(), name=None):
    """A product file with ``extra`` columns before the wanted ones."""
    folder.mkdir(parents=True, exist_ok=True)
    values = {"Date": "2024-01-{:02d}", "Barcode": barcode, "OnPromotion": "0", "Quantity": "{}.5", "Holiday": "0"}
    names = ["Date", *[f"more {i}" for i in range(extra)], *[c for c in HEADER if c != "Date" and c not in lack]]
    lines = [",".join(names)]
    for i in range(rows):
        lines.append(",".join('"a, ""b"""' if n.startswith("more") else values.get(n, "1.0").format(i + 1) for n in names))
    (folder / (name or f"produto_{barcode}.csv")).write_text("﻿" + "\r\n".join(lines) + "\r\n\r\n")


def test_wide_product_files(spark, tmp_path):
    wide_file(tmp_path, "1")
    wide_file(tmp_path, "2", extra=500)
    wide_file(tmp_path, "3", lack=("Quantity", "UnitValue"))
    good, bad = files.read_series(spark, str(tmp_path))
    assert sorted((r.barcode, r.date.day, r.quantity, r.holiday) for r in good.collect()) == [(b, i, i + 0.5, 0) for b in "12" for i in (1, 2)]
    assert {(r.barcode, r.reject_reason) for r in bad.collect()} == {("3", "no column Quantity")}
    assert bad.count() == 2 and all(r[files.CORRUPT].startswith("2024-01-0") for r in bad.collect())
    good, bad = files.read_series(spark, str(tmp_path), wanted=["Date"])
    assert good.count() == 6 and bad.count() == 0


def test_cells(spark):
    lines = ["", "a", ",", 'a,"b,c",d', '"x ""y"" z",', '"open, b', " a , b ", '"', '"a"b,c', "1," * 3000 + "2", '"' + "q," * 9000 + '"']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    got = [r.c for r in df.select("i", files.cells(F.col("s")).alias("c")).orderBy("i").collect()]
    assert got[:9] == [[""], ["a"], ["", ""], ["a", "b,c", "d"], ['x "y" z', ""], ['"open', "b"], ["a", "b"], ['"'], ['"a"b', "c"]]
    assert len(got[9]) == 3001 and got[10] == ["q," * 9000]


def test_late_files_are_read_by_their_own_headers(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    wide_file(raw, "1")
    stream = intake.new_series(spark, str(raw))
    wide_file(raw, "2", extra=3)  # after the stream was set up
    intake.append_available(stream, out, ckpt)
    assert {r.barcode for r in spark.read.parquet(out).collect()} == {"1", "2"}
    wide_file(raw, "3", extra=0)
    (raw / "produto_1.csv").write_text("no longer a product file\n")  # taken in before, so never read again
    intake.append_available(intake.new_series(spark, str(raw)), out, ckpt)
    got = spark.read.parquet(out).groupBy("barcode").count().collect()
    assert {tuple(r) for r in got} == {("1", 2), ("2", 2), ("3", 2)}


def test_good_and_rejected_rows_in_one_pass(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    wide_file(raw, "1")
    wide_file(raw, "2", lack=("Holiday",))
    (raw / "produto_3.csv").write_text("2024-01-01,3,0\n")
    intake.take_in_series(spark, str(raw), out, ckpt, files_per_batch=1)
    intake.take_in_series(spark, str(raw), out, ckpt)
    good, bad = intake.taken_in(spark, out)
    assert sorted((r.barcode, r.quantity) for r in good.collect()) == [("1", 1.5), ("1", 2.5)]
    assert sorted((r.barcode, r.file, r.reject_reason) for r in bad.collect()) == [
        ("2", "produto_2.csv", "no column Holiday"),
        ("2", "produto_2.csv", "no column Holiday"),
        ("3", "produto_3.csv", files.NO_HEADER),
    ]
    # A batch that runs again replaces what it wrote.
    lines = files.with_path(spark.read.option("pathGlobFilter", "produto_1.csv").text(str(raw)))
    rows = intake.tagged_batch(lines).withColumns({"part": F.lit(intake.SERIES), "batch": F.lit(77)})
    for _ in range(2):
        intake._replace(rows, out, "part", "batch")
    assert intake.taken_in(spark, out)[0].count() == 4


def test_product_files_by_name(spark, tmp_path):
    days = [(b, d, 1, 0, 1.0, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0) for b in ("7", "8") for d in dates(3)]
    schema = "barcode string, date date, product_code int, on_promotion int, quantity double, returned_quantity double, discount double, increase double, total_value double, unit_value double, cost_value double, holiday int"
    dense = spark.createDataFrame(days, schema)
    tables.write_series(dense, str(tmp_path / "s"), "m")
    tables.name_product_files(spark, str(tmp_path / "s"), str(tmp_path / "raw"))
    assert sorted(p.name for p in (tmp_path / "raw").glob("*.csv")) == ["produto_7.csv", "produto_8.csv"]
    good, bad = files.read_series(spark, str(tmp_path / "raw"))
    assert good.count() == 6 and bad.count() == 0
    tables.move_files(spark, str(tmp_path / "raw"), str(tmp_path / "done"), lambda name: "7" in name)
    assert sorted(p.name for p in (tmp_path / "done").glob("*.csv")) == ["produto_7.csv"]
    tables.write_series(dense.where("barcode = '8'"), str(tmp_path / "t"), "m")
    with pytest.raises(FileExistsError):
        tables.name_product_files(spark, str(tmp_path / "t"), str(tmp_path / "raw"))


# --------------------------------------------------------------------- versions


def predicted(spark, model, value):
    rows = [(model, "a", dt.date(2024, m, 1), 2.0, value) for m in (1, 2)]
    return spark.createDataFrame(rows, "model string, barcode string, date date, real double, forecast double")


def test_comparison_changes_as_a_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    both = predicted(spark, "x", 1.0).unionByName(predicted(spark, "y", 3.0))
    assert tables.write_comparison(both, ["x", "y"], path) == 1
    read = lambda table, number=None: versions.read_version(spark, path, table, number)
    assert {t: read(t).count() for t in tables.COMPARED} == {"metrics": 2, "predictions": 2, "annual": 1, "daily": 2}
    # A run that fails midway leaves the last version as it was.
    with monkeypatch.context() as m:
        m.setattr(tables, "_by_month", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.write_comparison(predicted(spark, "x", 9.0), ["x"], path)
    assert versions.entries(spark, path) == [1] and read("annual").first().x == 2.0
    assert tables.write_comparison(predicted(spark, "x", 9.0), ["x"], path) == 2
    assert {t: read(t).count() for t in tables.COMPARED} == {"metrics": 1, "predictions": 2, "annual": 1, "daily": 2}
    assert read("annual").first().x == 18.0 and read("annual", 1).first().x == 2.0
    assert versions.publish(spark, path, versions.stage(path)) == 3
    versions.prune(spark, path, keep=2)
    assert versions.entries(spark, path) == [2, 3] and versions.folder_of(spark, path, 1) is None
    with pytest.raises(ValueError, match="no published"):
        versions.read_version(spark, str(tmp_path / "none"), "metrics")


# ---------------------------------------------------------------------- rejects


def test_rejects_are_tagged_and_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None), (4, None)], "product_code bigint, barcode string")
    reasons = {"no code": F.col("product_code").isNull(), "no barcode": F.col("barcode").isNull()}
    tagged, seen = rejects.counted(rejects.tag(df, reasons), reasons)
    tagged.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"kept": 1, "no code": 2, "no barcode": 1}
    back = spark.read.parquet(str(tmp_path / "t"))
    assert rejects.kept(back).count() == 1 and rejects.rejected(back).count() == 3
    named, left_out = lookup.anonymised_parts(df)
    assert sorted(r.product_code for r in named.collect()) == [1, 2]
    assert {(r.barcode, r.reject_reason) for r in left_out.collect()} == {("b", lookup.NO_CODE), (None, lookup.NO_CODE)}


# ------------------------------------------------------------------ split reads


class Reader:
    """Stands in for a session whose database holds the keys given."""

    def __init__(self, keys):
        self.keys, self.asked, self.calls = keys, {}, []

    read = property(lambda self: self)
    sparkContext = type("Context", (), {"defaultParallelism": 6})

    def format(self, kind):
        self.asked = {"format": kind}
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **values):
        self.asked |= values
        return self

    def load(self):
        self.calls.append(self.asked)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "table": table, "predicates": predicates, "properties": properties})
        return self

    def first(self):
        return (len(self.keys),)

    def collect(self):
        parts = int(self.asked["query"].split("ntile(")[1].split(")")[0])
        return [{"first_key": min(p)} for p in np.array_split(sorted(self.keys), parts) if len(p)]


def test_reads_are_split_by_the_keys(spark):
    keys = [*range(1000), *[5000] * 500, 10**9]
    reader = Reader(keys)
    database.read_by_key(reader, "jdbc:x", "sales", "id", {"user": "u"}, rows_per_part=100)
    call = reader.calls[-1]
    assert call["properties"]["user"] == "u" and call["table"] == "sales"
    assert len(call["predicates"]) > 10
    # Every key, also new and null ones, is in one range; ranges are alike but for one key held by many rows.
    df = spark.createDataFrame([(k,) for k in [*keys, -5, 2 * 10**9, None]], "id bigint")
    sizes = [df.where(p).count() for p in call["predicates"]]
    assert sum(sizes) == len(keys) + 3 and max(sizes) <= 700 and sorted(sizes)[-2] <= 102
    assert database.range_predicates("id", []) == database.range_predicates("id", [4]) == ["1 = 1"]


def test_equal_ranges_and_single_reads():
    reader = Reader([])
    database.read_table(reader, "jdbc:x", "t", split_on="id", lower=0, upper=90)
    assert reader.calls[-1] | {"numPartitions": 6, "partitionColumn": "id", "lowerBound": 0, "upperBound": 90} == reader.calls[-1]
    database.read_table(reader, "jdbc:x", "t", split_on="id", lower=0, upper=90, partitions=3)
    assert reader.calls[-1]["numPartitions"] == 3
    database.read_table(reader, "jdbc:x", "t")
    assert "numPartitions" not in reader.calls[-1] and reader.calls[-1]["dbtable"] == "t"
    database.read_query(reader, "jdbc:x", "SELECT 1", {"user": "u"})
    assert reader.calls[-1]["query"] == "SELECT 1" and reader.calls[-1]["user"] == "u"


def test_plan_reads_a_comparison_version(spark, tmp_path):
    inputs = series_inputs(spark)
    plan = forecast.Plan(str(tmp_path / "p"), "2024-01-01", 2024, str(tmp_path / "c"))
    tables.write_predictions(predicted(spark, "x", 1.0), plan.predictions)
    tables.write_predictions(predicted(spark, "y", 1.0), plan.predictions)
    reuse = {n: forecast.ModelOptions(forecast.REUSE) for n in ("x", "y")}
    forecast.run(spark, inputs, plan, reuse)
    assert versions.read_version(spark, plan.comparison, "annual").first().real == 4.0


# ------------------------------------------------------------------------ sums


@pytest.mark.parametrize(
    "values, whole, thousandths",
    [
        ([0.1] * 10, 1.0, 1000.0),
        ([123456.7, 0.3], 123457.0, 123457000.0),
        ([-0.1] * 15, -1.0, -1500.0),
        ([-2.5, 0.5], -2.0, -2000.0),
        ([-0.2, 0.1], 0.0, -100.0),
        ([0.33334] * 3, 1.0, 1000.02),
        ([1e12 + 0.25, 0.75], 1e12 + 1, 1e15 + 1000),
        ([4e17, 1.0], 4e17 + 0.0, 4e20),
        ([None, float("nan"), float("inf"), float("-inf"), 7.25], 7.0, 7250.0),
        ([], None, None),
    ],
)
def test_exact_parts(spark, values, whole, thousandths):
    from shelfcast.functions.numeric import exact_parts, truncated, units

    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    a, b = (F.sum(x) for x in exact_parts(df, "v"))
    got = df.agg(truncated(a, b).alias("whole"), units(a, b, 1000).alias("units")).first()
    assert (got.whole, got.units) == (whole, pytest.approx(thousandths, rel=1e-13) if thousandths is not None else None)
    assert got.whole is None or str(got.whole) != "-0.0"


def test_exact_parts_of_decimals(spark):
    from shelfcast.functions.numeric import exact_parts, truncated, units

    df = spark.sql("SELECT * FROM VALUES (CAST('-12345678901234567.1234' AS DECIMAL(30,4))), (CAST('0.1234' AS DECIMAL(30,4))), (NULL) AS t(v)")
    a, b = (F.sum(x) for x in exact_parts(df, "v"))
    got = df.agg(truncated(a, b).alias("whole"), units(a, b, 1000).alias("units")).first()
    assert got.whole == -12345678901234567.0 and got.units == pytest.approx(-12345678901234567000.0)


@pytest.mark.parametrize("name", ["series_intake", "rejected_rows", "compare_merge_coverage", "comparison_version", "forecast_keys"])
def test_lines_are_read_once(spark, monkeypatch, name):
    days, read = 460, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    sales = spark.range(days).select(
        F.col("id").alias("sale_id"), F.expr("timestamp_ntz'1999-06-01 10:00:00' + make_dt_interval(id)").alias("sold_at")
    )
    products = spark.createDataFrame([(k, f"700000000000{k}") for k in (1, 2)], schemas.PRODUCTS)
    lines = sales.select("sale_id").join(products.select("product_code")).select(
        "sale_id",
        "product_code",
        F.lit("700001").alias("barcode"),
        F.lit(0).alias("on_promotion"),
        (F.col("sale_id") % 7 + 1).cast("double").alias("quantity"),
        F.lit(0.0).alias("returned_quantity"),
        F.lit(2.0).alias("unit_value"),
        F.lit(1.0).alias("cost_value"),
        F.lit(0.1).alias("discount"),
        F.lit(0.1).alias("increase"),
    )
    plain = star.Store(sales, lines, products)
    watched = star.Store(sales, lines.mapInArrow(counted, lines.schema), products)
    monkeypatch.setattr(queries, "store", lambda spark, folder, product="brand": watched if product == "brand" else plain)
    queries.REGISTRY[name](spark, "").collect()
    assert read.value == 2 * days

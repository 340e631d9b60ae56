"""Every operator as a query over the star-schema tables.

Dates leave as ISO text and decimals rounded half up, so that results can be
compared with another engine value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import half_up
from shelfcast.models import boosted, ridge
from shelfcast.operators import (
    calendar,
    compare,
    features,
    folds,
    inventory,
    lookup,
    metrics,
    rollup,
    scaling,
)
from shelfcast.plans import demand
from shelfcast.schemas import FEATURES
from shelfcast.session import materialise, scratch_path
from shelfcast.sinks import tables, versions
from shelfcast.sources import files, predictions, star
from shelfcast.sources.star import END, SPLIT, START, YEAR
from shelfcast.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
MODELS = list(demand.CLOSED_FORM)
WEEKLY = folds.Fold(365, 7, 7)
MONTHLY = folds.Fold(365, 31, 30)
EARLY = "1995-02-10"  # by when not every supplier has a usable row


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates as text, decimals rounded."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        kind = f.dataType.typeName()
        if kind == "double":
            c = half_up(c, digits).alias(f.name)
        elif kind == "date":
            c = c.cast("string").alias(f.name)
        columns.append(c)
    return df.select(*columns)


def query(name: str, digits: int = 6) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir), digits)

        REGISTRY[name] = run
        return fn

    return register


def store(spark: SparkSession, sf_dir: str, product: str = "brand") -> star.Store:
    return star.open_store(spark, sf_dir, product)


def inputs(spark: SparkSession, sf_dir: str, product: str = "brand") -> DataFrame:
    return demand.model_inputs(store(spark, sf_dir, product))


def train(spark: SparkSession, sf_dir: str, product: str = "brand") -> DataFrame:
    return folds.split_by_date(inputs(spark, sf_dir, product), SPLIT, YEAR)[0]


def predicted(spark: SparkSession, sf_dir: str, product: str = "brand") -> DataFrame:
    return demand.closed_form_predictions(inputs(spark, sf_dir, product))


# ---------------------------------------------------------------- daily series


@query("daily_sales")
def daily_sales(spark, sf_dir):
    return demand.daily(store(spark, sf_dir))


@query("daily_sales_split")
def daily_sales_split(spark, sf_dir):
    """The same result with the medians searched in price cells."""
    st = store(spark, sf_dir)
    return rollup.daily_sales(st.lines, st.sales, st.products, START, END, split_hot=True)


@query("daily_sales_wanted")
def daily_sales_wanted(spark, sf_dir):
    """Only the products of the most representative parts."""
    top = lookup.top_products(star.revenue_scores(spark, sf_dir), store(spark, sf_dir, "part").products)
    return demand.daily(store(spark, sf_dir, "part"), wanted=top)


@query("merge_duplicate_days")
def merge_duplicate_days(spark, sf_dir):
    return demand.merged(store(spark, sf_dir))


@query("calendar_dense")
def calendar_dense(spark, sf_dir):
    return demand.dense(store(spark, sf_dir))


def _promoted(spark, sf_dir):
    """Suppliers with only their promoted lines that came back in large numbers: some have none."""
    st = store(spark, sf_dir, "supplier")
    return star.Store(st.sales, st.lines.where("on_promotion = 1 and returned_quantity > 40"), st.products)


@query("calendar_unsold")
def calendar_unsold(spark, sf_dir):
    """Suppliers without a sale in the year have zeros on every day."""
    return demand.dense(_promoted(spark, sf_dir), "1996-01-01", "1996-12-31")


@query("calendar_assortment")
def calendar_assortment(spark, sf_dir):
    """All lines and the whole period; codes of the assortment that never sold have zeros on every day."""
    return demand.dense(store(spark, sf_dir, "assortment"))


@query("holiday_flags")
def holiday_flags(spark, sf_dir):
    series = demand.dense(store(spark, sf_dir)).select("barcode", "date", "quantity")
    return calendar.flag_holidays(series, calendar.holiday_dates(spark, int(START[:4]), int(END[:4])))


@query("holiday_override")
def holiday_override(spark, sf_dir):
    return demand.with_holidays(demand.dense(store(spark, sf_dir)).select("barcode", "date", "quantity")).drop("holiday_eve")


@query("holiday_override_rows")
def holiday_override_rows(spark, sf_dir):
    return calendar.overridden_rows(demand.dense(store(spark, sf_dir)))


@query("daily_export")
def daily_export(spark, sf_dir):
    return tables.export_series(demand.with_holidays(demand.dense(store(spark, sf_dir))))


@query("consolidated")
def consolidated(spark, sf_dir):
    return tables.consolidated(demand.with_holidays(demand.dense(store(spark, sf_dir))))


@query("product_files")
def product_files(spark, sf_dir):
    """The export written as one file per product and read back."""
    path = scratch_path(spark, "series")
    tables.write_series(demand.with_holidays(demand.dense(store(spark, sf_dir))), path, "market-1")
    return files.read_written_series(spark, path)


def _product_files(spark, sf_dir, width: int = 0, without=None) -> str:
    """A folder of the export as one file per product under its published name.

    ``width`` more columns stand before the last ones. ``without`` names a column and a
    test of the product code; those products' files lack it.
    """
    dense = demand.with_holidays(demand.dense(store(spark, sf_dir)))
    more = [F.lit(i).alias(f"extra_{i}") for i in range(width)]
    rows = tables.export_series(dense, more)
    folder = scratch_path(spark, "raw")
    if without is None:
        parts = [rows]
    else:
        rows = materialise(rows, "export")  # both parts are written from it
        lacking = without[1](F.col("Barcode").cast("bigint"))
        parts = [rows.where(~lacking), rows.where(lacking).drop(without[0])]
    for part in parts:
        path = scratch_path(spark, "series")
        tables.write_files(part, path, "market-1")
        tables.name_product_files(spark, path, folder)
    return folder


@query("series_folder")
def series_folder(spark, sf_dir):
    """Product files of 41 columns, read back by their headers."""
    return files.read_series(spark, _product_files(spark, sf_dir, width=30))[0]


@query("series_intake")
def series_intake(spark, sf_dir):
    """Product files taken in as they arrive: those of odd codes are there at first, the others come later."""
    early = _product_files(spark, sf_dir, without=("TotalValue", lambda code: code % 2 == 0))
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "taken", "taken-checkpoint"))
    for parity in (1, 0):
        tables.move_files(spark, early, folder, lambda name, parity=parity: int(name.removesuffix(".csv")[-1]) % 2 == parity)
        intake.take_in_series(spark, folder, out, checkpoint)
    return intake.taken_in(spark, out)[0].drop("total_value")


@query("rejected_rows")
def rejected_rows(spark, sf_dir):
    """What operators leave out, by reason: files that lack a column, lines without a code, products that cannot be scaled."""
    folder = _product_files(spark, sf_dir, without=("Quantity", lambda code: code % 3 == 0))
    unread = files.read_series(spark, folder)[1].select(F.lit("read").alias("step"), "barcode", "reject_reason")
    lines = store(spark, sf_dir, "part").lines
    code = F.when(lookup.plausible_barcode(F.col("barcode")), F.col("product_code"))
    uncoded = lookup.anonymised_parts(lines.select("barcode", code.alias("product_code")))[1]
    uncoded = uncoded.select(F.lit("anonymise").alias("step"), "barcode", "reject_reason")
    late = boosted.panel_parts(inputs(spark, sf_dir, "supplier"), EARLY, int(EARLY[:4]))[1]
    unscaled = late.select(F.lit("scale").alias("step"), "barcode", "reject_reason")
    rows = unread.unionByName(uncoded).unionByName(unscaled)
    return rows.groupBy("step", "barcode", "reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query("quality_counts")
def quality_counts(spark, sf_dir):
    st = store(spark, sf_dir)
    return rollup.quality_counts(st.lines, st.sales, st.products, START, END)


# -------------------------------------------------------------------- features


@query("calendar_features")
def calendar_features(spark, sf_dir):
    days = demand.dense(store(spark, sf_dir)).select("barcode", "date")
    extra = calendar.calendar_columns(days).select("barcode", "date", "weekend", "week_of_month")
    return extra.transform(features.calendar_features)


@query("lag_features")
def lag_features(spark, sf_dir):
    series = demand.with_holidays(demand.dense(store(spark, sf_dir)))
    lags = [f"lag_{n}" for n in features.LAGS]
    return features.history_features(series).select("barcode", "date", *lags, "holiday_lag_1", "promo_lag_1")


@query("rolling_features")
def rolling_features(spark, sf_dir):
    series = demand.dense(store(spark, sf_dir))
    return features.history_features(series).select("barcode", "date", "rolling_mean_7", "rolling_std_7")


@query("rate_features")
def rate_features(spark, sf_dir):
    series = demand.dense(store(spark, sf_dir))
    rates = features.rate_features(features.history_features(series))
    return rates.select("barcode", "date", "discount_rate", "increase_rate", "returned_rate", "profit_margin")


@query("features_clean")
def features_clean(spark, sf_dir):
    return inputs(spark, sf_dir)


@query("rows_per_series")
def rows_per_series(spark, sf_dir):
    """Days and usable rows per supplier; those without a sale have no usable row."""
    rows = demand.model_inputs(_promoted(spark, sf_dir), "1996-01-01", "1996-12-31", drop_incomplete=False)
    return features.rows_per_series(rows)


@query("rows_per_series_assortment")
def rows_per_series_assortment(spark, sf_dir):
    """Days and usable rows of the whole assortment; codes that never sold have no usable row."""
    rows = demand.model_inputs(store(spark, sf_dir, "assortment"), drop_incomplete=False)
    return features.rows_per_series(rows)


@query("train_forecast_split")
def train_forecast_split(spark, sf_dir):
    before, year = folds.split_by_date(inputs(spark, sf_dir).select("barcode", "date", "quantity"), SPLIT, YEAR)
    return before.withColumn("part", F.lit("train")).unionByName(year.withColumn("part", F.lit("forecast")))


# --------------------------------------------------------- windows and scaling


@query("rolling_windows")
def rolling_windows(spark, sf_dir):
    return folds.rolling_windows(train(spark, sf_dir).select("barcode", "date", "quantity"), MONTHLY)


@query("window_bounds")
def window_bounds(spark, sf_dir):
    return folds.window_bounds(train(spark, sf_dir), WEEKLY)


@query("validation_split")
def validation_split(spark, sf_dir):
    return folds.validation_split(train(spark, sf_dir).select("barcode", "date")).withColumn(
        "is_validation", F.col("is_validation").cast("int")
    )


@query("window_split")
def window_split(spark, sf_dir):
    """The cut between rows to fit on and rows to validate on inside every weekly window."""
    return folds.split_bounds(train(spark, sf_dir), WEEKLY)


@query("window_validation_rows")
def window_validation_rows(spark, sf_dir):
    return folds.window_validation_rows(train(spark, sf_dir).select("barcode", "date", "quantity"), MONTHLY)


@query("scaler_by_window")
def scaler_by_window(spark, sf_dir):
    return scaling.scaler_by_window(train(spark, sf_dir), FEATURES, WEEKLY)


@query("scaled_by_window")
def scaled_by_window(spark, sf_dir):
    """Test rows of every weekly window, scaled by what was known before it."""
    return scaling.scaled_test_rows(train(spark, sf_dir), FEATURES, WEEKLY)


@query("scaler_stats")
def scaler_stats(spark, sf_dir):
    return scaling.scaler_stats(train(spark, sf_dir), FEATURES)


@query("scaled_features")
def scaled_features(spark, sf_dir):
    is_train = F.col("date") < F.lit(SPLIT).cast("date")
    return scaling.scale(inputs(spark, sf_dir), FEATURES, is_train).select("barcode", "date", *FEATURES)


@query("leakage_corr")
def leakage_corr(spark, sf_dir):
    """Every weekly backtest window, as the check inside the loop does."""
    return scaling.leakage_correlations(train(spark, sf_dir), FEATURES, WEEKLY)


@query("sequences")
def sequences(spark, sf_dir):
    rows = inputs(spark, sf_dir)
    steps = folds.sequences(rows, FEATURES).select("barcode", "date", "target", F.posexplode("sequence").alias("step", "inputs"))
    inputs_by_name = [F.get("inputs", F.lit(i)).alias(c) for i, c in enumerate(FEATURES)]
    return steps.select("barcode", "date", "target", "step", *inputs_by_name)


# --------------------------------------------------------- scores and backtest


@query("naive_baseline")
def naive_baseline(spark, sf_dir):
    return metrics.naive_baseline(train(spark, sf_dir))


@query("backtest_naive")
def backtest_naive(spark, sf_dir):
    return demand.closed_form_backtest(inputs(spark, sf_dir), WEEKLY)


@query("metrics_by_window")
def metrics_by_window(spark, sf_dir):
    rows = demand.closed_form_backtest(inputs(spark, sf_dir), WEEKLY)
    return metrics.metrics_by_window(rows.withColumn("forecast", F.col("mean7")))


@query("metrics_by_series")
def metrics_by_series(spark, sf_dir):
    return metrics.pooled_metrics(predicted(spark, sf_dir), ["model", "barcode"])


@query("metrics_by_model")
def metrics_by_model(spark, sf_dir):
    return metrics.pooled_metrics(predicted(spark, sf_dir))


@query("metrics_mean_of_daily")
def metrics_mean_of_daily(spark, sf_dir):
    return metrics.mean_of_daily_metrics(predicted(spark, sf_dir), ["model", "barcode"])


@query("metrics_last_month")
def metrics_last_month(spark, sf_dir):
    return metrics.last_month_metrics(predicted(spark, sf_dir))


# ------------------------------------------------------------------ comparison


@query("compare_merge")
def compare_merge(spark, sf_dir):
    """The two models predict different halves of the days, so that only some days have both."""
    p = predicted(spark, sf_dir)
    covered = ((F.col("model") == "naive") & (F.month("date") <= 9)) | ((F.col("model") == "mean7") & (F.month("date") >= 4))
    return compare.merge_models(p.where(covered), MODELS)


@query("compare_merge_coverage")
def compare_merge_coverage(spark, sf_dir):
    """All days of a model that needs the day before only, against the complete rows of one that needs all inputs."""
    rows = demand.model_inputs(store(spark, sf_dir), drop_incomplete=False)
    made = {"naive": ("lag_1", F.col("lag_1").isNotNull()), "mean7": ("rolling_mean_7", features.is_complete(rows))}
    both = [F.struct(F.lit(m).alias("model"), F.col(c).alias("forecast"), has.alias("has")) for m, (c, has) in made.items()]
    # Both models come out of one pass over the rows.
    p = rows.select("barcode", "date", F.col("quantity").alias("real"), F.inline(F.array(*both))).where("has")
    return compare.merge_models(p, MODELS)


@query("daily_errors")
def daily_errors(spark, sf_dir):
    return compare.compared_errors(compare.merge_models(predicted(spark, sf_dir), MODELS), MODELS)


@query("annual_summary")
def annual_summary(spark, sf_dir):
    return compare.annual_summary(compare.merge_models(predicted(spark, sf_dir), MODELS), MODELS)


@query("chart_series")
def chart_series(spark, sf_dir):
    return compare.chart_series(compare.merge_models(predicted(spark, sf_dir), MODELS), MODELS)


@query("comparison_version")
def comparison_version(spark, sf_dir):
    """Scores of the second of two written versions."""
    path, p = scratch_path(spark, "comparison"), materialise(predicted(spark, sf_dir), "predicted")
    tables.write_comparison(p.where("model = 'naive'"), MODELS[:1], path)
    tables.write_comparison(p, MODELS, path)
    return versions.read_version(spark, path, "metrics")


@query("harmonised")
def harmonised(spark, sf_dir):
    """Two models' outputs under their own column names, as one table."""
    p = predicted(spark, sf_dir)
    own = {m: p.where(F.col("model") == m).drop("model") for m in MODELS}
    own["naive"] = own["naive"].select("barcode", F.col("date").alias("Date"), F.col("real").alias("Quantity"), F.col("forecast").alias("YHAT"))
    own["mean7"] = own["mean7"].withColumnRenamed("forecast", "prediction_mean7")
    return compare.stack_models(own)


@query("predictions_reload")
def predictions_reload(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    tables.write_predictions(predicted(spark, sf_dir), path)
    return predictions.read_predictions(spark, path, "naive")


# ------------------------------------------------------- products and inventory


@query("top_products")
def top_products(spark, sf_dir):
    return lookup.top_products(star.revenue_scores(spark, sf_dir), store(spark, sf_dir, "part").products)


@query("barcode_lookup")
def barcode_lookup(spark, sf_dir):
    parts = store(spark, sf_dir, "part")
    wanted = parts.products.select("barcode").unionByName(store(spark, sf_dir, "supplier").products.select("barcode"))
    return lookup.resolve_barcodes(wanted, parts.lines)


@query("anonymise_codes")
def anonymise_codes(spark, sf_dir):
    sold = store(spark, sf_dir, "part").lines.groupBy("product_code").agg(F.count(F.lit(1)).alias("lines"))
    return lookup.anonymise_codes(sold)


def _artifacts(spark, sf_dir):
    """Part months by order date stand for predictions, by shipping date for charts."""
    barcode = star.part_barcode(F.col("l_partkey")).alias("barcode")
    items = star.table(spark, sf_dir, "lineitem")
    orders = star.table(spark, sf_dir, "orders").where(F.year("o_orderdate") == YEAR)
    ordered = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(barcode, "o_orderdate")
    shipped = items.where(F.year("l_shipdate") == YEAR).select(barcode, "l_shipdate")
    return inventory.artifact_months(ordered, "o_orderdate"), inventory.artifact_months(shipped, "l_shipdate")


def _file_sets(spark, sf_dir):
    """Raw files: plausible barcodes. Moved files: barcodes sold to one market."""
    products = store(spark, sf_dir, "part").products
    raw = products.where(lookup.plausible_barcode(F.col("barcode"))).select("barcode")
    return raw, star.market_barcodes(spark, sf_dir, "BUILDING")


@query("missing_predictions")
def missing_predictions(spark, sf_dir):
    return inventory.missing_predictions(store(spark, sf_dir, "part").products, _artifacts(spark, sf_dir)[0])


@query("month_coverage")
def month_coverage(spark, sf_dir):
    return inventory.month_coverage(store(spark, sf_dir, "part").products, *_artifacts(spark, sf_dir), YEAR)


@query("status_report")
def status_report(spark, sf_dir):
    coverage = inventory.month_coverage(store(spark, sf_dir, "part").products, *_artifacts(spark, sf_dir), YEAR)
    return inventory.report_lines(coverage)


@query("inventory_status")
def inventory_status(spark, sf_dir):
    return inventory.inventory_status(*_file_sets(spark, sf_dir), *_artifacts(spark, sf_dir))


@query("inventory_counts")
def inventory_counts(spark, sf_dir):
    return inventory.inventory_counts(*_file_sets(spark, sf_dir), *_artifacts(spark, sf_dir))


@query("barcode_reconcile")
def barcode_reconcile(spark, sf_dir):
    """Plausible barcodes against those sold in two markets."""
    listed, _ = _file_sets(spark, sf_dir)
    found = [star.market_barcodes(spark, sf_dir, m) for m in ("BUILDING", "MACHINERY")]
    return inventory.reconcile(listed, *found)


@query("report_file")
def report_file(spark, sf_dir):
    """The status report as it stands in its file."""
    path = scratch_path(spark, "report")
    coverage = inventory.month_coverage(store(spark, sf_dir, "part").products, *_artifacts(spark, sf_dir), YEAR)
    tables.write_report(inventory.report_lines(coverage), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("difference_files")
def difference_files(spark, sf_dir):
    """Both lists of the reconciliation as they stand in their files."""
    path = scratch_path(spark, "differences")
    listed, _ = _file_sets(spark, sf_dir)
    found = [star.market_barcodes(spark, sf_dir, m) for m in ("BUILDING", "MACHINERY")]
    tables.write_differences(inventory.reconcile(listed, *found), path)
    return spark.read.text(path).select(F.col("value").alias("barcode"), "difference")


@query("patched_version")
def patched_version(spark, sf_dir):
    """The export without holidays, patched by the local days as a new version."""
    path = scratch_path(spark, "patched")
    dense = demand.dense(store(spark, sf_dir)).withColumn("holiday", F.lit(0))
    tables.patch_series(tables.export_series(dense), path, fmt="parquet")
    return spark.read.parquet(path).select("Barcode", "Date", "Quantity", "Holiday")


@query("barcode_list")
def barcode_list(spark, sf_dir):
    """A list file with blanks and repeats: the barcodes of all lines."""
    path = scratch_path(spark, "list")
    sold = store(spark, sf_dir, "part").lines.select(F.concat(F.lit(" "), "barcode", F.lit(" ")))
    sold.write.text(path)
    return files.read_barcode_list(spark, path)


@query("folder_barcodes")
def folder_barcodes(spark, sf_dir):
    """Barcodes by the names of the files in a folder."""
    return files.barcodes_in_folder(spark, _product_files(spark, sf_dir))


@query("numbered_codes")
def numbered_codes(spark, sf_dir):
    """The codes of the top products with their place in the list."""
    top = lookup.top_products(star.revenue_scores(spark, sf_dir), store(spark, sf_dir, "part").products)
    return lookup.numbered(spark, [r.product_code for r in top.collect()])  # a thousand at most


@query("extra_steps")
def extra_steps(spark, sf_dir):
    """Features with a step of one's own, whose incomplete rows go as well."""
    series = demand.with_holidays(demand.dense(store(spark, sf_dir))).drop("holiday_eve", "product_code")
    ahead = lambda df: df.withColumn("lag_sum", F.col("lag_1") + F.col("lag_7")).withColumn(
        "sold_share", F.try_divide("quantity", F.col("lag_7"))
    )
    return features.build_features(series, extra=[ahead]).select("barcode", "date", "quantity", "lag_sum", "sold_share")


# -------------------------------------------------------------------- streaming


@query("events_intake")
def events_intake(spark, sf_dir):
    """Event rows taken in as a stream of new files, then one row per day and type."""
    out = scratch_path(spark, "events")
    schema = star.table(spark, sf_dir, "events").schema
    source = intake.new_files(spark, sf_dir, schema, "parquet", glob="events.parquet")
    intake.append_available(source, out, scratch_path(spark, "events-checkpoint"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (
        spark.read.schema(schema).parquet(out)
        .groupBy(F.to_date("ts").alias("date"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), (F.sum(cents).cast("double") / 100.0).alias("value"))
    )


# ----------------------------------------------------------------------- models


@query("backtest_ridge")
def backtest_ridge(spark, sf_dir):
    return ridge.backtest(inputs(spark, sf_dir), SPLIT, WEEKLY)


@query("backtest_linear", digits=4)
def backtest_linear(spark, sf_dir):
    """The window models with one input and no penalty, which is a straight line per window."""
    return ridge.backtest(inputs(spark, sf_dir), SPLIT, WEEKLY, ["lag_1"], clip=False, penalties=[0.0]).drop("penalty")


@query("backtest_sequence")
def backtest_sequence(spark, sf_dir):
    return ridge.backtest_sequence(inputs(spark, sf_dir), SPLIT)


@query("forecast_sequence")
def forecast_sequence(spark, sf_dir):
    return ridge.forecast_sequence(inputs(spark, sf_dir), SPLIT, YEAR)


@query("forecast_gbt")
def forecast_gbt(spark, sf_dir):
    panel = boosted.panel_rows(inputs(spark, sf_dir), SPLIT, YEAR)
    return boosted.forecast(panel, boosted.fit_base(panel, SPLIT), YEAR)


@query("forecast_keys")
def forecast_keys(spark, sf_dir):
    """The rows that the boosted and the sequence forecast have, their actual values, and whether forecasts are as promised."""
    rows = materialise(inputs(spark, sf_dir), "inputs")
    panel = boosted.panel_rows(rows, SPLIT, YEAR)
    quick = boosted.Settings(rounds=3)
    trees = boosted.forecast(panel, boosted.fit_base(panel, SPLIT, quick), YEAR)
    both = trees.unionByName(ridge.forecast_sequence(rows, SPLIT, YEAR, clip=True))
    fine = (F.col("forecast").isNotNull() & ~F.isnan("forecast") & (F.col("forecast") >= 0)).cast("int")
    return both.select("model", "barcode", "date", "real", fine.alias("fine"))


@query("forecast_walk_forward")
def forecast_walk_forward(spark, sf_dir):
    panel = boosted.panel_rows(inputs(spark, sf_dir), SPLIT, YEAR)
    return boosted.walk_forward(panel, boosted.fit_base(panel, SPLIT), YEAR)[0]

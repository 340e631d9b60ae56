"""Gradient boosted trees over the panel of all products.

Inputs and target are scaled per series, so that one model serves products of any
volume. Trees are fitted by Spark ML on distributed data. The statistics are a
table of their own, kept with the model: whoever scores joins them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import rejects
from shelfcast.functions.numeric import clip_low
from shelfcast.schemas import FEATURES
from shelfcast.session import materialise, shared_dir
from shelfcast.sinks import models as saved

# Settings of the published model. Rounds and rate are our own, see Settings.
PUBLISHED = {"maxDepth": 5, "maxBins": 64, "subsamplingRate": 0.8, "minInstancesPerNode": 3, "seed": 42}
FEATURE_SHARE = "0.8"

# Share of a series' train rows that trees are fitted on; the rest decides when to stop.
TRAIN_SHARE = 0.8
NO_TRAIN = "no train rows"


@dataclass(frozen=True)
class Settings:
    """Boosting goes on until ``patience`` rounds in a row bring no better error on the validation rows.

    ``block`` rounds are fitted first, and twice as many as long as the best one lies
    among the last ``patience``; ``rounds`` is only a stop for data on which that never
    ends. After a month, ``update_rounds`` trees are fitted to its residuals, but for every
    ``held_out``-th day. They enter with the one of ``update_weights`` that most lowers the
    error on the days held out, or not at all.
    """

    rounds: int = 10_000
    patience: int = 50
    block: int = 100
    rate: float = 0.3
    update_rounds: int = 5
    held_out: int = 3
    update_weights: tuple[float, ...] = (0.1, 0.3, 1.0)


@dataclass
class Boosted:
    """A base model and the corrections learnt from the months since, each with its weight."""

    base: PipelineModel
    updates: list[tuple[float, GBTRegressionModel]] = field(default_factory=list)

    def score(self, panel: DataFrame) -> DataFrame:
        """Add ``z_forecast``, the scaled forecast."""
        df = self.base.transform(panel).withColumnRenamed("prediction", "_p0")
        total: Column = F.col("_p0")
        for i, (weight, update) in enumerate(self.updates, 1):
            df = update.setPredictionCol(f"_p{i}").transform(df)
            total = total + F.col(f"_p{i}") * F.lit(weight)
        return df.withColumn("z_forecast", total).drop(*[f"_p{i}" for i in range(len(self.updates) + 1)])


def series_stats(inputs: DataFrame, split: str, columns: Iterable[str] = FEATURES, series: str = "barcode") -> DataFrame:
    """``series, train_rows, means, stds`` of the rows before ``split``: the inputs in order, then the target.

    One pass with partial aggregation. A deviation of 0 becomes 1.
    """
    measured = [F.col(c).cast("double") for c in (*columns, "quantity")]
    stds = [F.stddev_pop(x) for x in measured]
    return (
        inputs.where(F.col("date") < F.lit(split).cast("date"))
        .groupBy(series)
        .agg(
            F.count(F.lit(1)).alias("train_rows"),
            F.array(*[F.avg(x) for x in measured]).alias("means"),
            F.array(*[F.when(s == 0, F.lit(1.0)).otherwise(s) for s in stds]).alias("stds"),
        )
    )


def scaled_rows(inputs: DataFrame, stats: DataFrame, columns: Iterable[str] = FEATURES, series: str = "barcode") -> DataFrame:
    """``series, date, quantity``, the scaled inputs and target, and what turns a forecast back.

    Rows of a series without statistics are tagged as rejected, their scaled values null.
    """
    columns = list(columns)
    rows = inputs.select(series, "date", "quantity", *columns).join(stats, series, "left")

    def scaled(name: str, place: int) -> Column:
        return (F.col(name).cast("double") - F.col("means")[place]) / F.col("stds")[place]

    last = len(columns)
    tagged = rejects.tag(rows, {NO_TRAIN: F.col("train_rows").isNull()})
    return tagged.select(
        series,
        "date",
        "quantity",
        *[scaled(c, i).alias(c) for i, c in enumerate(columns)],
        scaled("quantity", last).alias("z_quantity"),
        F.col("means")[last].alias("_level"),
        F.col("stds")[last].alias("_spread"),
        "train_rows",
        rejects.REASON,
    )


def panel_parts(
    inputs: DataFrame,
    split: str,
    year: int,
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
    stats: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The panel, and the rows of series that cannot be scaled; both of one written table.

    The panel has the scaled train rows, the last fifth of each series marked as
    validation, and those of the forecast year. Every boosting round and month
    reads it again.
    """
    columns = list(columns)
    before = F.col("date") < F.lit(split).cast("date")
    wanted = inputs.where(before | (F.year("date") == year))
    if stats is None:
        stats = series_stats(inputs, split, columns, series)
    rows = scaled_rows(wanted, stats, columns, series)
    # Train rows come first in date order, so a row's number is its place among them.
    place = F.row_number().over(Window.partitionBy(series).orderBy("date")) - 1
    rows = rows.withColumn("_place", place).withColumn(
        "is_validation", before & (F.col("_place") >= F.floor(F.col("train_rows") * TRAIN_SHARE))
    )
    written = materialise(rows.drop("_place", "train_rows"), "panel")
    left_out = rejects.rejected(written).select(series, "date", F.col("quantity").alias("real"), rejects.REASON)
    return rejects.kept(written), left_out


def panel_rows(
    inputs: DataFrame,
    split: str,
    year: int,
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
    stats: DataFrame | None = None,
) -> DataFrame:
    """The panel of ``panel_parts`` alone."""
    return panel_parts(inputs, split, year, columns, series, stats)[0]


def _regressor(settings: Settings, rounds: int, label: str) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxIter=rounds,
        stepSize=settings.rate,
        featureSubsetStrategy=FEATURE_SHARE,
        **PUBLISHED,
    )


def shortened(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The ensemble of the first ``trees`` trees."""
    own = model._java_obj
    jvm, gateway = SparkSession.active()._jvm, SparkSession.active().sparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression
    some, weights = gateway.new_array(kind.DecisionTreeRegressionModel, trees), gateway.new_array(jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(own.trees()[:trees], model.treeWeights[:trees])):
        some[i], weights[i] = tree, weight
    cut = kind.GBTRegressionModel(own.uid(), some, weights)
    for name in ("featuresCol", "labelCol"):
        cut.set(cut.getParam(name), own.getOrDefault(own.getParam(name)))
    return GBTRegressionModel(cut)


def fit_trees(train: DataFrame, settings: Settings = Settings()) -> tuple[GBTRegressionModel, list[float]]:
    """Trees up to the best round, and the validation error after each round that was fitted.

    ``train`` has ``features``, ``z_quantity`` and ``is_validation``. Without validation
    rows the train rows take their place.
    """
    fitted_on, checked_on = train.where("NOT is_validation"), train.where("is_validation")
    if checked_on.isEmpty():
        checked_on = fitted_on
    rounds = min(settings.block, settings.rounds)
    while True:
        model = _regressor(settings, rounds, "z_quantity").fit(fitted_on)
        errors = model.evaluateEachIteration(checked_on, "absolute")
        best = min(range(len(errors)), key=errors.__getitem__) + 1
        if len(errors) - best >= settings.patience or rounds >= settings.rounds:
            return shortened(model, best), errors
        rounds = min(2 * rounds, settings.rounds)


def fit_base(
    panel: DataFrame, split: str, settings: Settings = Settings(), columns: Iterable[str] = FEATURES
) -> PipelineModel:
    """One model on all rows before ``split``, stopped early on the last fifth of each series."""
    shared_dir(panel.sparkSession)  # long boosting chains are cut by checkpoints in the shared folder
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    train = assembler.transform(panel.where(F.col("date") < F.lit(split).cast("date")))
    return PipelineModel([assembler, fit_trees(train.select("features", "z_quantity", "is_validation"), settings)[0]])


def _unscaled(scored: DataFrame, model: str, series: str, clip: bool) -> DataFrame:
    forecast = F.col("z_forecast") * F.col("_spread") + F.col("_level")
    return scored.select(
        F.lit(model).alias("model"),
        series,
        "date",
        F.col("quantity").alias("real"),
        (clip_low(forecast) if clip else forecast).alias("forecast"),
    )


def forecast(
    panel: DataFrame, base: PipelineModel, year: int, model: str = "boosted", series: str = "barcode", clip: bool = True
) -> DataFrame:
    """The forecast year scored by the base model alone."""
    return _unscaled(Boosted(base).score(panel.where(F.year("date") == year)), model, series, clip)


def walk_forward(
    panel: DataFrame,
    base: PipelineModel,
    year: int,
    settings: Settings = Settings(),
    model: str = "boosted",
    series: str = "barcode",
    clip: bool = True,
) -> tuple[DataFrame, Boosted]:
    """Forecast a month, learn its residuals, go on to the next.

    The current forecast is a column of a written table of the year's rows. A
    month's trees are fitted to what it leaves unexplained in that month and applied
    to the table once. They enter only with a weight that lowers the mean absolute
    error on days of the month that they were not fitted on, by more than twice the
    standard error of that gain. A month is forecast by
    what was known before it began; its column is not touched later. The plan of
    each step starts at the table of the step before, so it does not grow.
    """
    own = [series, "date", "quantity", "z_quantity", "_level", "_spread", "features"]
    start = base.transform(panel.where(F.year("date") == year))
    first = [F.col("prediction").alias(c) for c in ("_state", "z_forecast")]
    carried = materialise(start.select(*own, F.month("date").alias("_month"), *first), "carried")
    state = Boosted(base)
    if carried.isEmpty():
        raise ValueError(f"no rows in {year} to forecast")
    left = F.col("z_quantity") - F.col("_state")
    weights = settings.update_weights
    held_out = F.dayofmonth("date") % settings.held_out == 0

    for number in range(1, 13):
        now = F.col("_month") == number
        residual = carried.where(now & ~held_out).select("features", left.alias("_residual"))
        if residual.isEmpty():
            continue
        update = _regressor(settings, settings.update_rounds, "_residual").fit(residual)
        tried = materialise(update.setPredictionCol("_step").transform(carried), "carried")
        gains = [F.abs(left) - F.abs(left - F.col("_step") * F.lit(w)) for w in weights]
        gains = [g * F.col("_spread") for g in gains]
        sums = [F.struct(F.avg(g).alias("mean"), (F.stddev_samp(g) / F.sqrt(F.count(g))).alias("off")) for g in gains]
        seen = tried.where(now & held_out).agg(*[x.alias(f"w{i}") for i, x in enumerate(sums)]).first()
        sure = [(g["mean"], w) for g, w in zip(seen, weights) if g["off"] is not None and g["mean"] > 2 * g["off"]]
        weight = max(sure, default=(0.0, 0.0))[1]
        if weight:
            state.updates.append((weight, update))
            moved = F.col("_state") + F.col("_step") * F.lit(weight)
            later = F.when(F.col("_month") > number, moved).otherwise(F.col("z_forecast"))
            carried = tried.select(*own, "_month", moved.alias("_state"), later.alias("z_forecast"))
    return _unscaled(carried, model, series, clip), state


def fit_or_load(
    spark: SparkSession,
    inputs: DataFrame,
    split: str,
    year: int,
    path: str | None,
    settings: Settings = Settings(),
    columns: Iterable[str] = FEATURES,
    series: str = "barcode",
) -> tuple[DataFrame, PipelineModel]:
    """The panel and the model: the ones saved under ``path`` if the inputs have the same names, else new ones.

    A saved model scores by the statistics it was saved with, whatever rows have come since.
    """
    columns = list(columns)
    found = saved.load_model(spark, columns, path) if path else None
    if found is not None and found.stats is not None:
        return panel_rows(inputs, split, year, columns, series, found.stats), found.model
    stats = materialise(series_stats(inputs, split, columns, series), "stats")
    panel = panel_rows(inputs, split, year, columns, series, stats)
    base = fit_base(panel, split, settings, columns)
    if path:
        saved.save_model(spark, base, columns, path, stats)
    return panel, base

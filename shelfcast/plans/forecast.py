"""Run, reuse or skip each model, then compare what there is."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfcast.models import boosted, ridge
from shelfcast.operators import compare, features
from shelfcast.operators.metrics import daily_errors
from shelfcast.sinks import tables
from shelfcast.sources.predictions import read_predictions
from shelfcast.streaming import intake

RUN, REUSE, SKIP = "run", "reuse", "skip"


@dataclass(frozen=True)
class ModelOptions:
    """What to do with one model.

    ``reset`` drops all its saved months first, otherwise a run replaces only the
    months it forecasts.
    """

    mode: str = RUN
    reset: bool = False

    def __post_init__(self):
        if self.mode not in (RUN, REUSE, SKIP):
            raise ValueError(f"mode {self.mode!r}; expected run, reuse or skip")


@dataclass(frozen=True)
class Plan:
    """Forecast year, split and outputs of one run over all products."""

    predictions: str
    split: str
    year: int
    comparison: str | None = None
    saved_models: str | None = None
    settings: boosted.Settings = boosted.Settings()


def run_boosted(inputs: DataFrame, plan: Plan, options: ModelOptions) -> DataFrame:
    path = f"{plan.saved_models}/boosted" if plan.saved_models and not options.reset else None
    panel, base = boosted.fit_or_load(inputs.sparkSession, inputs, plan.split, plan.year, path, plan.settings)
    return boosted.walk_forward(panel, base, plan.year, plan.settings)[0]


def run_sequence(inputs: DataFrame, plan: Plan, options: ModelOptions) -> DataFrame:
    """Fitted anew every time: its closed form costs no more than loading it."""
    return ridge.forecast_sequence(inputs, plan.split, plan.year)


RUNNERS = {"boosted": run_boosted, "sequence": run_sequence}


def run(
    spark: SparkSession, inputs: DataFrame | None, plan: Plan, models: Mapping[str, ModelOptions]
) -> dict[str, DataFrame]:
    """Predictions of every model that was run or reused.

    With ``plan.comparison`` set and two or more models at hand, their comparison
    is written as well. Predictions are read back from disk, so a comparison never
    fits a model twice.
    """
    out = {}
    for name, options in models.items():
        if options.mode == SKIP:
            continue
        if options.mode == RUN:
            if inputs is None:
                raise ValueError(f"{name} is to be run but there are no inputs")
            tables.write_predictions(RUNNERS[name](inputs, plan, options), plan.predictions, reset=options.reset)
        out[name] = read_predictions(spark, plan.predictions, name)
        if out[name].isEmpty():
            raise RuntimeError(f"no saved predictions of {name} in {plan.predictions}")
    if plan.comparison and len(out) > 1:
        tables.write_comparison(compare.stack_models(out), list(out), plan.comparison)
    return out


def forecast_new_files(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    split: str,
    year: int,
    files_per_batch: int | None = None,
) -> None:
    """Forecast the products whose series files arrived since the last call.

    Uses the sequence model, whose products do not depend on one another. The
    checkpoint remembers the files, so nothing has to be moved out of the folder.
    """

    def step(batch: DataFrame) -> DataFrame:
        return daily_errors(ridge.forecast_sequence(features.build_features(batch), split, year))

    intake.process_available(intake.new_series(spark, folder, files_per_batch), path, checkpoint, step)

"""Fitted models with all that scoring needs: input names in order, and the statistics they were scaled by."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from shelfcast.sinks import versions


@dataclass(frozen=True)
class Saved:
    """A model and, if it was saved with them, its statistics."""

    model: PipelineModel
    stats: DataFrame | None


def save_model(
    spark: SparkSession, model: PipelineModel, features: Iterable[str], path: str, stats: DataFrame | None = None
) -> None:
    """Model, names and statistics as one version: a reader never finds a model with another one's statistics."""
    folder = versions.stage(path)
    model.write().save(f"{folder}/model")
    rows = [(i, name) for i, name in enumerate(features)]
    spark.createDataFrame(rows, "position int, feature string").coalesce(1).write.parquet(f"{folder}/features")
    if stats is not None:
        stats.write.parquet(f"{folder}/stats")
    spark.createDataFrame([(stats is not None,)], "has_stats boolean").coalesce(1).write.parquet(f"{folder}/about")
    versions.publish(spark, path, folder)


def load_model(spark: SparkSession, features: Iterable[str], path: str) -> Saved | None:
    """What was saved last, or None if there is nothing or its inputs differ in name or order."""
    folder = versions.folder_of(spark, path)
    if folder is None:
        return None
    rows = spark.read.parquet(f"{folder}/features").collect()  # one row per input
    if [r.feature for r in sorted(rows)] != list(features):
        return None
    has_stats = spark.read.parquet(f"{folder}/about").first().has_stats
    return Saved(PipelineModel.load(f"{folder}/model"), spark.read.parquet(f"{folder}/stats") if has_stats else None)

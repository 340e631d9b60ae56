"""Saved predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.schemas import PREDICTIONS


def read_predictions(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Predictions written by ``sinks.predictions``; a model name reads only its folders."""
    df = spark.read.parquet(path)
    if model is not None:
        df = df.where(F.col("model") == model)
    return df.select(*PREDICTIONS.names)


def predicted_months(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Which product months have saved predictions."""
    df = spark.read.parquet(path)
    if model is not None:
        df = df.where(F.col("model") == model)
    return df.select("barcode", "year", "month").distinct()

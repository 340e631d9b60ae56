"""Rows that an operator leaves out, told apart in the pass that keeps the others."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "reject_reason"


def reason_of(reasons: Mapping[str, Column]) -> Column:
    """The first reason that holds, in the order given; null for a row that is kept."""
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in reasons.items()])


def tag(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reject_reason``. Neither side is computed twice if the result is written before it is split."""
    return df.withColumn(REASON, reason_of(reasons))


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def counted(tagged: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``tagged`` that counts its kept and rejected rows by reason while it is written or read by any action."""
    seen = Observation()
    counts = [F.count_if(F.col(REASON) == name).alias(name) for name in reasons]
    return tagged.observe(seen, F.count_if(F.col(REASON).isNull()).alias("kept"), *counts), seen

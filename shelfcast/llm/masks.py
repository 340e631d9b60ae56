"""Fixed-size bit filters: which values may be wanted, whatever their number.

A filter only saves work: what passes by chance is dropped by an exact join or
finds no partner later. It is packed in Spark, so the driver gets at most one
row per 64 bits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _packed(values: DataFrame, column: str, bits: int) -> DataFrame:
    """``word, set``: the filter's words of 64 bits that are not all 0."""
    bucket = F.expr(f"{column} & {(1 << bits) - 1}L")
    words = values.where(F.col(column).isNotNull()).select(F.shiftright(bucket, 6).alias("word"), (bucket % 64).cast("int").alias("bit"))
    return words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))


def passing(rows: DataFrame, values: DataFrame, column: str, bits: int = 22) -> DataFrame:
    """The rows whose bigint ``column`` passes the filter of that of ``values``, by Spark alone: the filter's words are broadcast."""
    words = F.broadcast(_packed(values, column, bits))
    same = F.expr(f"shiftright({column} & {(1 << bits) - 1}L, 6) = word")
    return rows.join(words, same & F.expr(f"shiftrightunsigned(set, cast({column} & 63L AS int)) & 1L = 1L"), "left_semi")


def mask_of(values: DataFrame, column: str, bits: int = 22) -> np.ndarray:
    """The filter of a bigint column, ``2 ** bits`` bits."""
    packed = _packed(values, column, bits).toPandas()
    mask = np.zeros(1 << (bits - 6), np.int64)
    mask[packed["word"].to_numpy(np.int64)] = packed["set"].to_numpy(np.int64)
    return mask.view(np.uint64)


def in_mask(values: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Whether each 64-bit value passes."""
    bucket = values.view(np.uint64) & np.uint64(len(mask) * 64 - 1)
    return (mask[bucket >> np.uint64(6)] >> (bucket & np.uint64(63))) & np.uint64(1) == 1

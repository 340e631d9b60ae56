"""Choosing products and giving them codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import rejects
from shelfcast.functions.text import plausible_barcode
from shelfcast.session import materialise


def top_products(scores: DataFrame, products: DataFrame, limit: int = 1000) -> DataFrame:
    """The ``limit`` products with the highest score and a plausible barcode."""
    return (
        scores.join(products.where(plausible_barcode(F.col("barcode"))), "product_code")
        .select("product_code", "barcode", "score")
        .orderBy(F.desc("score"), "product_code", "barcode")
        .limit(limit)
    )


def resolve_barcodes(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """The product code of each wanted barcode, null where no line has it.

    All barcodes are looked up in one pass; the lowest code wins where a barcode
    was sold under several.
    """
    asked = wanted.select("barcode").where(F.col("barcode").isNotNull()).distinct()
    codes = lines.where(F.col("barcode").isNotNull()).groupBy("barcode").agg(F.min("product_code").alias("product_code"))
    return asked.join(codes, "barcode", "left")


def unresolved(resolved: DataFrame) -> DataFrame:
    """Barcodes that ``resolve_barcodes`` found no product for."""
    return resolved.where(F.col("product_code").isNull()).select("barcode")


def sequential_codes(df: DataFrame, column: str = "product_code") -> DataFrame:
    """Map of each distinct code to 1, 2, 3 .. in code order.

    Codes are ranked inside ranges of a sorted table and the ranges are offset by
    the sizes of the ones before, so that no task holds all codes. Only one row
    per range is ordered globally.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = df.select(column).where(F.col(column).isNotNull()).distinct()
    # Range bounds are sampled anew on every run, so both uses below read one written copy.
    ordered = materialise(
        codes.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()), "codes"
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return (
        ordered.withColumn("_rank", inside)
        .join(F.broadcast(offsets), "_part")
        .select(column, (F.col("_offset") + F.col("_rank")).cast("bigint").alias("anonymous_code"))
    )


NO_CODE = "no code"


def anonymised_parts(df: DataFrame, column: str = "product_code") -> tuple[DataFrame, DataFrame]:
    """Rows with sequential codes in place of the real ones, and those that have no code, tagged; of one written table."""
    tagged = materialise(rejects.tag(df, {NO_CODE: F.col(column).isNull()}), "codes")
    codes = sequential_codes(rejects.kept(tagged), column)
    named = rejects.kept(tagged).join(codes, column).drop(column).withColumnRenamed("anonymous_code", column)
    return named, rejects.rejected(tagged)


def anonymise_codes(df: DataFrame, column: str = "product_code") -> DataFrame:
    """Replace real codes by sequential ones. Rows without a code are left out; ``anonymised_parts`` has them too."""
    return df.join(sequential_codes(df, column), column).drop(column).withColumnRenamed("anonymous_code", column)


def numbered(spark: SparkSession, codes: Sequence, column: str = "product_code") -> DataFrame:
    """A given list of codes with its 1-based order."""
    return spark.createDataFrame([(list(codes),)], ["codes"]).select(
        F.posexplode("codes").alias("_pos", column)
    ).select(column, (F.col("_pos") + 1).alias("sequence"))

"""Which products and months are done, missing or unexpected.

Products are given as tables with a ``barcode`` column, artifacts as tables with
``barcode``, ``year`` and ``month``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.text import two_digits


def barcodes(df: DataFrame) -> DataFrame:
    return df.select("barcode").where(F.col("barcode").isNotNull()).distinct()


def missing_predictions(raw: DataFrame, predicted: DataFrame) -> DataFrame:
    """Products with input but without any prediction."""
    return barcodes(raw).join(barcodes(predicted), "barcode", "left_anti")


def processed(predicted: DataFrame, charted: DataFrame) -> DataFrame:
    """Products that have predictions and charts."""
    return barcodes(predicted).intersect(barcodes(charted))


def _memberships(**sets: DataFrame) -> DataFrame:
    """One row per product with a flag for each set: the sets are tagged and folded in one aggregation, without joins."""
    rows = None
    for tag, df in sets.items():
        part = df.where(F.col("barcode").isNotNull()).select("barcode", *[F.lit(int(t == tag)).alias(t) for t in sets])
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("barcode").agg(*[F.max(t).cast("boolean").alias(t) for t in sets])


def inventory_status(raw: DataFrame, moved: DataFrame, predicted: DataFrame, charted: DataFrame) -> DataFrame:
    """State of each processed product.

    ``can_move`` is processed and still among the raw files, ``already_moved`` is
    processed and among the moved ones, ``only_processed`` is in neither. A product
    in both file sets has two rows.
    """
    states = F.array(
        F.when(F.col("raw"), "can_move"),
        F.when(F.col("moved"), "already_moved"),
        F.when(~F.col("raw") & ~F.col("moved"), "only_processed"),
    )
    per_product = _memberships(raw=raw, moved=moved, predicted=predicted, charted=charted)
    return per_product.where("predicted AND charted").select("barcode", F.explode(F.array_compact(states)).alias("status"))


def inventory_counts(raw: DataFrame, moved: DataFrame, predicted: DataFrame, charted: DataFrame) -> DataFrame:
    """How many products are in each set and state.

    The counts are one aggregation and not one join each.
    """
    per_product = _memberships(raw=raw, moved=moved, predicted=predicted, charted=charted)
    done = F.col("predicted") & F.col("charted")
    return per_product.agg(
        F.count_if("raw").alias("total_raw"),
        F.count_if("moved").alias("total_moved"),
        F.count_if(done).alias("total_processed"),
        F.count_if(done & F.col("raw")).alias("can_move"),
        F.count_if(done & F.col("moved")).alias("already_moved"),
        F.count_if(done & ~F.col("raw") & ~F.col("moved")).alias("only_processed"),
        F.count_if(F.col("raw") & ~done).alias("remaining"),
    )


def _months(artifacts: DataFrame, year: int, name: str) -> DataFrame:
    months = artifacts.where(F.col("year") == year).groupBy("barcode").agg(F.collect_set("month").alias(name))
    return months


def month_coverage(products: DataFrame, predicted: DataFrame, charted: DataFrame, year: int) -> DataFrame:
    """Months of ``year`` that lack a prediction or a chart, for each product.

    At most twelve months are collected per product.
    """
    expected = F.array(*[F.lit(m) for m in range(1, 13)])

    def missing(name: str):
        found = F.coalesce(F.col(name), F.array().cast("array<int>"))
        return F.array_sort(F.array_except(expected, found))

    def listed(name: str):
        return F.array_join(F.transform(missing(name), two_digits), ", ")

    return (
        barcodes(products)
        .join(_months(predicted, year, "_predicted"), "barcode", "left")
        .join(_months(charted, year, "_charted"), "barcode", "left")
        .select(
            "barcode",
            listed("_predicted").alias("missing_predictions"),
            listed("_charted").alias("missing_charts"),
            ((F.size(missing("_predicted")) == 0) & (F.size(missing("_charted")) == 0)).cast("int").alias("complete"),
        )
    )


def report_lines(coverage: DataFrame) -> DataFrame:
    """Text of the status report: complete products first, then the others with what they lack."""
    gaps = F.concat_ws(
        " | ",
        F.when(F.col("missing_predictions") != "", F.concat(F.lit("predictions missing for months: "), "missing_predictions")),
        F.when(F.col("missing_charts") != "", F.concat(F.lit("charts missing for months: "), "missing_charts")),
    )
    return coverage.select(
        F.when(F.col("complete") == 1, 0).otherwise(1).alias("section"),
        "barcode",
        F.when(F.col("complete") == 1, F.format_string("- %s", "barcode"))
        .otherwise(F.format_string("Product %s: %s", F.col("barcode"), gaps))
        .alias("line"),
    )


def reconcile(listed: DataFrame, *found: DataFrame) -> DataFrame:
    """Barcodes on the list but in no market, and in some market but not on the list."""
    everywhere = barcodes(found[0])
    for more in found[1:]:
        everywhere = everywhere.union(barcodes(more))
    everywhere, listed = everywhere.distinct(), barcodes(listed)
    return (
        listed.join(everywhere, "barcode", "left_anti")
        .select("barcode", F.lit("listed_not_found").alias("difference"))
        .unionByName(
            everywhere.join(listed, "barcode", "left_anti").select("barcode", F.lit("found_not_listed").alias("difference"))
        )
    )


def artifact_months(df: DataFrame, date: str = "date") -> DataFrame:
    """The product months that a table of dated rows covers."""
    return df.select("barcode", F.year(date).alias("year"), F.month(date).alias("month")).distinct()

"""Series, predictions and reports on disk."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import calendar, compare
from shelfcast.operators.metrics import daily_errors
from shelfcast.schemas import EXPORT_COLUMNS
from shelfcast.session import materialise
from shelfcast.sinks import versions

# Tables replace only the partitions they bring; everything else at the path stays.
REPLACE_PARTITIONS = {"partitionOverwriteMode": "dynamic"}


def export_series(dense: DataFrame, more: Iterable[Column] = ()) -> DataFrame:
    """The daily series under its published column names; ``more`` columns stand behind the first two."""
    named = [F.col(new).alias(old) for new, old in EXPORT_COLUMNS.items()]
    return dense.select(*named[:2], *more, *named[2:])


def write_series(dense: DataFrame, path: str, market: str, fmt: str = "csv", per_product: bool = True) -> None:
    """One folder and file per product, below the market's folder.

    A series is at most one calendar long, so one task writes it; products are
    spread over the tasks by hash. With ``per_product=False`` a file holds many
    whole series, for stores with more products than a file system likes folders.
    """
    write_files(export_series(dense), path, market, fmt, per_product)


def write_files(export: DataFrame, path: str, market: str, fmt: str = "csv", per_product: bool = True) -> None:
    """An exported series as in ``write_series``."""
    out = export.withColumns({"product": F.col("Barcode"), "market": F.lit(market)})
    (
        out.repartition("product")
        .sortWithinPartitions("product", "Date")
        .write.mode("overwrite")
        .options(header=True, **REPLACE_PARTITIONS)
        .partitionBy("market", *(["product"] if per_product else []))
        .format(fmt)
        .save(path)
    )


def name_product_files(spark: SparkSession, path: str, folder: str) -> None:
    """Move the files below ``path`` that ``write_series`` made, one per product, to ``folder/produto_<barcode>.csv``.

    Only names change, on the driver; one per product. A file of that name is not replaced.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(make(folder))
    for status in fs.globStatus(make(f"{path.rstrip('/')}/market=*/product=*/part-*.csv")):
        product = status.getPath().getParent().getName().partition("=")[2]
        if not fs.rename(status.getPath(), make(f"{folder.rstrip('/')}/produto_{product}.csv")):
            raise FileExistsError(f"{folder}/produto_{product}.csv")


def move_files(spark: SparkSession, path: str, folder: str, chosen: Callable[[str], bool]) -> None:
    """Move the files of ``path`` whose name is ``chosen`` to ``folder``, as processed files are; only names change."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(make(folder))
    for status in fs.listStatus(make(path)):
        name = status.getPath().getName()
        if not name.startswith(".") and chosen(name) and not fs.rename(status.getPath(), make(f"{folder.rstrip('/')}/{name}")):
            raise FileExistsError(f"{folder}/{name}")


def consolidated(dense: DataFrame) -> DataFrame:
    """All products in one table, ordered by day and product."""
    return dense.orderBy("date", "product_code", "barcode")


def write_consolidated(dense: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Ordered part files, or one file on demand."""
    out = consolidated(dense)
    (out.coalesce(1) if single_file else out).write.mode("errorifexists").option("header", True).format(fmt).save(path)


def write_predictions(predictions: DataFrame, path: str, reset: bool = False) -> None:
    """Daily predictions with their errors by model, year and month.

    Writing a model's months again replaces them and leaves other months and
    models alone; with ``reset`` all older months of the models at hand go.
    Products stay a column, so a month has few large files.
    """
    out = _with_file(daily_errors(predictions).withColumns({"year": F.year("date"), "month": F.month("date")}))
    if reset:
        # The models of one run are a handful of names; each has its own folder.
        out = materialise(out, "reset")
        for row in out.select("model").distinct().toLocalIterator():
            _by_month(out.where(F.col("model") == row.model).drop("model")).write.mode("overwrite").partitionBy(
                "year", "month"
            ).parquet(f"{path}/model={row.model}")
        return
    _by_month(out, "model").write.mode("overwrite").options(**REPLACE_PARTITIONS).partitionBy(
        "model", "year", "month"
    ).parquet(path)


def _by_month(df: DataFrame, *keys: str) -> DataFrame:
    return (
        df.repartition(*keys, "year", "month", "_file")
        .sortWithinPartitions(*keys, "year", "month", "barcode", "date")
        .drop("_file")
    )


def _with_file(df: DataFrame) -> DataFrame:
    """Number the files of a month by product, enough for all tasks to share one month's rows."""
    files = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 12)
    return df.withColumn("_file", F.pmod(F.xxhash64("barcode"), F.lit(files)))


COMPARED = ("metrics", "predictions", "annual", "daily")


def write_comparison(predictions: DataFrame, models: Iterable[str], path: str, series: str = "barcode") -> int:
    """Scores, predictions side by side, yearly sums and daily errors as one version; returns its number.

    All four are written whole, below a folder of their own, and become current
    together; a run that fails changes nothing. The predictions are merged once: the
    other tables are made of the written ones. Read them with ``versions.read_version``.
    """
    spark, models = predictions.sparkSession, list(models)
    folder = versions.stage(path)
    compare.merge_models(predictions, models, series).write.parquet(f"{folder}/predictions")
    merged = spark.read.parquet(f"{folder}/predictions")
    results = compare.compare_merged(merged, models, series)
    for name in ("metrics", "annual"):
        results[name].write.parquet(f"{folder}/{name}")
    _by_month(_with_file(results["daily"])).write.partitionBy("year", "month").parquet(f"{folder}/daily")
    return versions.publish(spark, path, folder)


def write_report(lines: DataFrame, path: str) -> None:
    """Lines of the status report in order of section and barcode."""
    lines.orderBy("section", "barcode").select("line").write.mode("errorifexists").text(path)


def write_differences(differences: DataFrame, path: str) -> None:
    """The two sorted barcode lists, one folder each."""
    (
        differences.repartitionByRange("difference", "barcode")
        .sortWithinPartitions("difference", "barcode")
        .write.mode("overwrite")
        .options(**REPLACE_PARTITIONS)
        .partitionBy("difference")
        .text(path)
    )


def patch_series(
    df: DataFrame, path: str, rules=calendar.LOCAL_HOLIDAYS, date: str = "Date", holiday: str = "Holiday", fmt: str = "csv"
) -> None:
    """Set extra holidays and write the result as a new version; the input is not touched."""
    calendar.override_holidays(df, rules, date, holiday).write.mode("errorifexists").option("header", True).format(fmt).save(path)

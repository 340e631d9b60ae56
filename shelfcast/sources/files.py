"""Product series, barcode lists and file inventories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import rejects, text
from shelfcast.schemas import EXPORT_COLUMNS, SERIES_FILE

CORRUPT = "_corrupt_record"
NO_HEADER, BAD_VALUE = "no header", "bad value"
# Columns without which a file's rows are of no use: those that model inputs are made of.
WANTED = tuple(f.name for f in SERIES_FILE if f.name not in ("Barcode", "TotalValue"))
# A cell and the comma before it; a quoted cell may hold commas and doubled quotes.
CELL = r',("(?:[^"]++|"")*+"(?=,|$)|[^,]*)'


def no_column(name: str) -> str:
    return f"no column {name}"


def cells(line: Column) -> Column:
    """The cells of a line, however many, trimmed and without their quotes."""
    found = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_replace(line, "^\ufeff", "")), F.lit(CELL), F.lit(1))
    inner = lambda c: F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')
    return F.transform(found, lambda c: F.trim(F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inner(c)).otherwise(c)))


def with_path(lines: DataFrame) -> DataFrame:
    """``_path, _file, line, cells`` of the lines of a text source; blank lines go."""
    path, name = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_file")
    return lines.where(F.trim("value") != "").select(path, name, F.col("value").alias("line"), cells(F.col("value")).alias("cells"))


def _is_header() -> Column:
    return F.array_contains("cells", "Date")


def headers(rows: DataFrame) -> DataFrame:
    """``_path, header`` of each file of ``rows(_path, cells)``."""
    return rows.where(_is_header()).groupBy("_path").agg(F.min("cells").alias("header"))


def parsed(rows: DataFrame, head: DataFrame, wanted: Iterable[str] = WANTED) -> DataFrame:
    """Cells by the names in their file's header, whatever its width and order, and the reason to reject a row.

    A row is rejected if its file has no header or lacks a wanted column, if its date
    is missing, or if a cell holds text that is no value of its column. Header rows go.
    """
    joined = rows.where(~_is_header()).join(head, "_path", "left")
    columns, wrong = [], F.lit(False)
    for f in SERIES_FILE.fields:
        place = F.array_position("header", f.name)
        cell = F.when(place > 0, F.get("cells", (place - 1).cast("int")))
        value = cell.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        if f.dataType != T.StringType():
            wrong = wrong | F.coalesce(cell.isNotNull() & (cell != "") & value.isNull(), F.lit(False))
        if f.name == "Date":
            wrong = wrong | value.isNull()
    reasons = {NO_HEADER: F.col("header").isNull()}
    reasons |= {no_column(name): ~F.array_contains("header", name) for name in wanted}
    reasons[BAD_VALUE] = wrong
    return joined.select("_file", F.col("line").alias(CORRUPT), *columns, rejects.reason_of(reasons).alias(rejects.REASON))


def barcode_of(only_product_files: bool = True) -> Column:
    return text.barcode_of_file(F.col("_file")) if only_product_files else text.stem(F.col("_file"))


def good_rows(tagged: DataFrame, only_product_files: bool = True) -> DataFrame:
    """The series of ``parsed`` rows, the barcode taken from the file's name."""
    named = [F.col(old).alias(new) for new, old in EXPORT_COLUMNS.items() if new != "barcode"]
    return rejects.kept(tagged).select(barcode_of(only_product_files).alias("barcode"), *named)


def bad_rows(tagged: DataFrame, only_product_files: bool = True) -> DataFrame:
    """``barcode, file, reject_reason, _corrupt_record``: the line of each rejected row."""
    barcode = barcode_of(only_product_files).alias("barcode")
    return rejects.rejected(tagged).select(barcode, F.col("_file").alias("file"), rejects.REASON, CORRUPT)


def read_series(
    spark: SparkSession,
    folder: str,
    only_product_files: bool = True,
    recursive: bool = False,
    wanted: Iterable[str] = WANTED,
) -> tuple[DataFrame, DataFrame]:
    """All product files of a folder as one table, and the rows that are rejected, with reasons.

    Columns are found by the file's header, however many there are. The barcode is
    the one in the file name. With ``only_product_files`` other names are left out,
    otherwise every visible ``.csv`` counts and its stem is the barcode. A line is
    a row; quoted cells may not hold line breaks.
    """
    glob = "produto_*.csv" if only_product_files else "*.csv"
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    rows = with_path(reader.text(folder))
    tagged = parsed(rows, headers(rows), wanted)
    return good_rows(tagged, only_product_files), bad_rows(tagged, only_product_files)


def read_barcode_list(spark: SparkSession, path: str) -> DataFrame:
    """One barcode per line; blanks and repeats dropped."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("barcode")).where(F.col("barcode") != "").distinct()


def barcodes_in_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Barcodes from the names of the product files; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "produto_*.csv")
        .option("recursiveFileLookup", recursive)
        .load(folder)
        .select(text.barcode_of_file(F.element_at(F.split("path", "/"), -1), digits_only=True).alias("barcode"))
        .where(F.col("barcode").isNotNull())
        .distinct()
    )


def read_written_series(spark: SparkSession, path: str) -> DataFrame:
    """Series as written by ``sinks.tables.write_series``, under their published names.

    Market and product folders are partition columns, so a filter on them reads
    only their files.
    """
    schema = T.StructType(
        [*SERIES_FILE.fields, T.StructField("market", T.StringType()), T.StructField("product", T.StringType())]
    )
    return spark.read.schema(schema).option("header", True).csv(path)

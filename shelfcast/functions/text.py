"""Names of files and lists of months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File naming of the product series.
PRODUCT_FILE = r"produto_(.+)\.csv$"
PRODUCT_FILE_DIGITS = r"produto_(\d+)\.csv$"
PRODUCT_PREFIX = r"^produto_"


def barcode_of_file(name: Column, digits_only: bool = False) -> Column:
    """Barcode inside ``produto_<barcode>.csv``, null for any other name."""
    found = F.regexp_extract(name, PRODUCT_FILE_DIGITS if digits_only else PRODUCT_FILE, 1)
    return F.when(found != "", found)


def stem(name: Column) -> Column:
    """File name without the ``.csv`` ending and the optional product prefix."""
    return F.regexp_replace(F.regexp_replace(name, r"\.csv$", ""), PRODUCT_PREFIX, "")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def plausible_barcode(barcode: Column) -> Column:
    """At least seven characters and starting with 7."""
    return (F.length(barcode) >= 7) & barcode.startswith("7")

"""Order and line item tables of a star schema as point-of-sale tables.

Products can be brands (several parts, hence several barcodes, per product),
suppliers or single parts. Line prices are the extended price per unit and the
cost is the retail price of the part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, END, SPLIT, YEAR = "1995-01-01", "2000-12-31", "2000-01-01", 2000


@dataclass(frozen=True)
class Store:
    """The point-of-sale tables."""

    sales: DataFrame
    lines: DataFrame
    products: DataFrame


# Given types save a look into the files before every read.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def part_barcode(partkey: Column) -> Column:
    """A barcode per part, some of them too short or with another first digit."""
    first = F.when(partkey % 5 == 0, "2").otherwise("7")
    width = F.when(partkey % 7 == 0, 5).otherwise(6)
    digits = partkey.cast("string")
    padded = F.concat(F.substring(F.repeat(F.lit("0"), 6), F.lit(1), F.greatest(width - F.length(digits), F.lit(0))), digits)
    return F.concat(first, padded)


def product_barcode(code: Column) -> Column:
    """A 13-digit barcode for products that are not single parts."""
    return F.concat(F.lit("7"), F.lpad(code.cast("string"), 12, "0"))


def brand_code(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)$", 1).cast("bigint")


def open_store(spark: SparkSession, folder: str, product: str = "brand") -> Store:
    """The tables with ``product`` = ``brand``, ``supplier``, ``part`` or ``assortment``.

    The assortment has all brands, and the suppliers under codes of their own, which no line bears.
    """
    part = table(spark, folder, "part")
    # Barcode and brand are worked out once per part, not once per line.
    parts = part.select(
        "p_partkey",
        F.col("p_retailprice").alias("cost_value"),
        part_barcode(F.col("p_partkey")).alias("barcode"),
        brand_code(F.col("p_brand")).alias("brand_code"),
    )
    items = table(spark, folder, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    code = {"brand": "brand_code", "assortment": "brand_code", "supplier": "l_suppkey", "part": "l_partkey"}[product]
    lines = items.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col(code).alias("product_code"),
        "barcode",
        (F.col("l_discount") >= 0.08).cast("int").alias("on_promotion"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("returned_quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_value"),
        "cost_value",
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("increase"),
    )
    sales = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("sold_at")
    )
    if product == "part":
        products = part.select(F.col("p_partkey").alias("product_code"), part_barcode(F.col("p_partkey")).alias("barcode"))
    else:
        codes = (
            part.select(brand_code(F.col("p_brand")).alias("product_code")).distinct()
            if product in ("brand", "assortment")
            else table(spark, folder, "supplier").select(F.col("s_suppkey").alias("product_code"))
        )
        products = codes.withColumn("barcode", product_barcode(F.col("product_code")))
        if product == "assortment":
            key = F.col("s_suppkey")
            unsold = table(spark, folder, "supplier").select(
                (-key).alias("product_code"), F.concat(F.lit("2"), F.lpad(key.cast("string"), 12, "0")).alias("barcode")
            )
            products = products.unionByName(unsold)
    return Store(sales, lines, products)


def revenue_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Each part's share of the revenue in cents, as its representativeness."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_code"))
        .agg((F.sum(cents).cast("double") / 100.0).alias("score"))
    )


def market_barcodes(spark: SparkSession, folder: str, segment: str) -> DataFrame:
    """Barcodes sold to the customers of one market segment."""
    customers = table(spark, folder, "customer").where(F.col("c_mktsegment") == segment).select("c_custkey")
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return (
        table(spark, folder, "lineitem")
        .join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .select("l_partkey")
        .distinct()
        .select(part_barcode(F.col("l_partkey")).alias("barcode"))
    )

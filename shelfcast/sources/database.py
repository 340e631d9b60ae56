"""Point-of-sale tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas


ROWS_PER_PART = 1_000_000


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None, fetch_rows: int = 10_000):
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_rows)
    return reader.options(**(properties or {}))


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """One table, read in ranges of equal width of the numeric column ``split_on``; without one, by a single task.

    There are as many ranges as the session has cores unless ``partitions`` says
    otherwise. Filters and column choices of later steps are sent to the database.
    ``read_by_key`` finds ranges itself.
    """
    reader = _reader(spark, url, properties, fetch_rows).option("dbtable", table)
    if split_on is not None:
        if lower is None or upper is None:
            raise ValueError("split_on needs lower and upper")
        bounds = {"partitionColumn": split_on, "lowerBound": lower, "upperBound": upper}
        reader = reader.options(**bounds, numPartitions=partitions or spark.sparkContext.defaultParallelism)
    return reader.load()


def read_by_key(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    properties: Mapping[str, str] | None = None,
    partitions: int | None = None,
    rows_per_part: int = ROWS_PER_PART,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """One table in ranges of a numeric key that hold about equally many rows, however the keys lie.

    The database is asked for its row count and for the quantiles of the key, one row
    per range. Rows whose key is null belong to the first range, rows that come
    between the two queries to the range of their key.
    """
    if partitions is None:
        count = read_query(spark, url, f"SELECT count(*) AS n FROM {table} t", properties).first()[0]
        partitions = max(1, -(-int(count) // rows_per_part))
    predicates = range_predicates(key, key_quantiles(spark, url, table, key, partitions, properties))
    return spark.read.jdbc(url, table, predicates=predicates, properties={**(properties or {}), "fetchsize": str(fetch_rows)})


# Tables of the point-of-sale database, and the keys that split them.
TABLES = {"sales": ("vendas", "Codigo"), "lines": ("vendasprodutos", "CodigoVenda"), "products": ("produtos", "Codigo")}


def read_store(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None, **how) -> dict[str, DataFrame]:
    """Sales, lines and products under our column names, each read in ranges of its key; ``how`` as in ``read_by_key``."""
    made = {"sales": sales, "lines": lines, "products": products}
    return {name: made[name](read_by_key(spark, url, *TABLES[name], properties, **how)) for name in TABLES}


def quantile_query(table: str, column: str, parts: int) -> str:
    """The least key of each of ``parts`` equally large groups of rows, in the database's own SQL."""
    grouped = f"SELECT {column} AS k, ntile({parts}) OVER (ORDER BY {column}) AS part FROM {table} t WHERE {column} IS NOT NULL"
    return f"SELECT part, min(k) AS first_key FROM ({grouped}) g GROUP BY part"


def key_quantiles(
    spark: SparkSession, url: str, table: str, column: str, parts: int, properties: Mapping[str, str] | None = None
) -> list[int]:
    """The first keys of the ranges, ascending and distinct; one row per range is fetched."""
    rows = read_query(spark, url, quantile_query(table, column, parts), properties).collect()
    return sorted({int(r["first_key"]) for r in rows})


def range_predicates(column: str, first_keys: Sequence[int]) -> list[str]:
    """One condition per range. Together they hold for every row once, also for keys that came since and null ones."""
    inner = list(first_keys)[1:]
    if not inner:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(inner, inner[1:])]
    return [f"{column} < {inner[0]} OR {column} IS NULL", *middle, f"{column} >= {inner[-1]}"]


def read_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    """The result of a query that the database runs itself."""
    return _reader(spark, url, properties).option("query", query).load()


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns of ``names`` under their new names, found in any letter case."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def sales(df: DataFrame) -> DataFrame:
    return renamed(df, schemas.SALE_COLUMNS)


def lines(df: DataFrame) -> DataFrame:
    return renamed(df, schemas.LINE_COLUMNS).withColumn("barcode", F.col("barcode").cast("string"))


def products(df: DataFrame) -> DataFrame:
    return renamed(df, schemas.PRODUCT_COLUMNS).withColumn("barcode", F.col("barcode").cast("string"))


def scores(df: DataFrame) -> DataFrame:
    return renamed(df, schemas.SCORE_COLUMNS)

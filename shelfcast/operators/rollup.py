"""Sale lines to one row per product and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse_day
from shelfcast.functions.numeric import DAILY_SCALE, SOURCE_SCALE, exact_parts, half_up, not_nan, truncated, units
from shelfcast.session import by_key, materialise


def sale_days(sales: DataFrame) -> DataFrame:
    """The day of each sale; text that is no date gives null."""
    sold_at = F.col("sold_at")
    is_text = sales.schema["sold_at"].dataType.typeName() == "string"
    return sales.select("sale_id", (parse_day(sold_at) if is_text else F.to_date(sold_at)).alias("date"))


def daily_sales(
    lines: DataFrame,
    sales: DataFrame,
    products: DataFrame,
    start: str,
    end: str,
    wanted: DataFrame | None = None,
    split_hot: bool = False,
) -> DataFrame:
    """Daily totals, mean discount and increase, and exact median prices.

    One row per day, product code and line barcode. ``wanted`` restricts the
    product codes. The header join comes first because it supplies the day; the
    product table is joined to the finished days, when a product that sells a
    third of all lines has shrunk to one row per day and barcode. ``split_hot``
    spreads the search for the median prices of one busy day over many tasks.
    """
    days = sale_days(sales).where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    kept = lines.where(F.col("barcode").isNotNull())
    if wanted is not None:
        kept = kept.join(wanted.select("product_code").distinct(), "product_code", "left_semi")
    sold = kept.join(days, "sale_id").withColumnRenamed("barcode", "line_barcode")
    barcodes = products.groupBy("product_code").agg(F.min("barcode").alias("barcode"))
    medians = split_median_days if split_hot else median_days
    return (
        medians(sold, ["date", "product_code", "line_barcode"])
        .join(barcodes, "product_code")
        .select(
            "date",
            "product_code",
            "line_barcode",
            "barcode",
            "on_promotion",
            "quantity",
            "returned_quantity",
            "unit_value",
            "cost_value",
            "discount",
            "increase",
            half_up(F.col("quantity") * F.col("unit_value")).alias("total_value"),
        )
    )


PRICES = ("unit_value", "cost_value")
MOVEMENTS = ("quantity", "returned_quantity", "discount", "increase")

# Price cells per doubling of the price in ``split_median_days``.
CELLS_PER_DOUBLING = 256


def _price_pairs(sold: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of a key with the same two prices combined, on the map side as well."""
    return (
        sold.select(
            *keys,
            *[F.coalesce(not_nan(F.col(c)), F.lit(0.0)).alias(c) for c in PRICES],
            F.when(F.col("on_promotion") == 1, 1).otherwise(0).alias("on_promotion"),
            *[part.alias(name) for c in MOVEMENTS for part, name in zip(exact_parts(sold, c), _parts(c))],
        )
        .groupBy(*keys, *PRICES)
        .agg(
            F.max("on_promotion").alias("on_promotion"),
            *[F.sum(name).alias(name) for c in MOVEMENTS for name in _parts(c)],
            F.count(F.lit(1)).alias("n"),
        )
    )


def _parts(c: str) -> tuple[str, str]:
    """The columns that hold an amount's whole units and the rest."""
    return f"{c}_whole", f"{c}_rest"


def _summed(c: str) -> tuple[Column, Column]:
    whole, rest = _parts(c)
    return F.sum(whole), F.sum(rest)


def _totals() -> list[Column]:
    def mean_of(c: str) -> Column:
        return half_up(units(*_summed(c), SOURCE_SCALE) / (F.sum("n") * F.lit(float(SOURCE_SCALE))))

    def whole(c: str) -> Column:
        """Total cut to whole units, towards zero as the source database does."""
        return truncated(*_summed(c))

    return [
        F.max("on_promotion").alias("on_promotion"),
        whole("quantity").alias("quantity"),
        whole("returned_quantity").alias("returned_quantity"),
        mean_of("discount").alias("discount"),
        mean_of("increase").alias("increase"),
    ]


def _low_rank(total: Column) -> Column:
    return F.floor((total + 1) / 2)


def _high_rank(total: Column) -> Column:
    """Equal to the low rank for an odd count."""
    return F.floor(total / 2) + 1


def _holds(rank: Column, upto: Column, n: Column) -> Column:
    """Whether the ``n`` rows that end at running count ``upto`` include ``rank``."""
    return (upto - n < rank) & (rank <= upto)


def median_days(sold: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and exact medians of ``unit_value`` and ``cost_value`` per key.

    Lines go to their key's partition once; there those with the same prices are
    combined and a running count finds the middle ranks. Aggregation and sort spill,
    no list of values is held. A key is one barcode's day, so a product with a third
    of all lines is spread over as many keys as it has days; a single day with more
    prices than one task should sort is for ``split_median_days``.
    """
    by_price = {c: Window.partitionBy(*keys).orderBy(c) for c in PRICES}
    everything = by_price["unit_value"].rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = _price_pairs(sold.repartition(*keys), keys).select(
        "*",
        # Framed over the whole key but ordered like the first running count, to share its sort.
        F.sum("n").over(everything).alias("total"),
        *[
            F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{c}_upto")
            for c, w in by_price.items()
        ],
    )

    def at(rank: Column, c: str) -> Column:
        return F.max(F.when(_holds(rank, F.col(f"{c}_upto"), F.col("n")), F.col(c)))

    total = F.col("total")
    return ranked.groupBy(*keys).agg(
        *_totals(),
        *[half_up((at(_low_rank(total), c) + at(_high_rank(total), c)) / 2).alias(c) for c in PRICES],
    )


def split_median_days(sold: DataFrame, keys: list[str]) -> DataFrame:
    """As ``median_days`` for keys with more distinct prices than one task should sort.

    A key whose lines all bear one price has that as its median. Where the lowest and
    the highest price differ, prices are counted in cells of nearly equal prices. The
    cells of a key, whose number does not grow with the lines, tell where the middle
    ranks lie, and only the prices inside those cells are ordered. No step brings a
    whole key to one task. The lines are read once: their combined pairs are written,
    and both prices are looked at as one long table. This is for stores known to have
    such days. Lines without a key are left out.
    """
    pairs = materialise(_price_pairs(sold.dropna(subset=keys), keys), "price-pairs")
    ends = {c: (F.min(c), F.max(c)) for c in PRICES}
    differing = pairs.groupBy(*keys).agg(*[(low < high).alias(f"{c}_open") for c, (low, high) in ends.items()])
    differing = differing.where(" OR ".join(f"{c}_open" for c in PRICES))
    medians = _middle_prices(pairs.join(differing, keys), keys).groupBy(*keys)
    medians = medians.agg(*[F.max(F.when(F.col("which") == c, F.col("middle"))).alias(f"{c}_middle") for c in PRICES])
    totals = pairs.groupBy(*keys).agg(*_totals(), *[half_up(low).alias(c) for c, (low, _) in ends.items()])
    return totals.join(medians, keys, "left").select(
        *[c for c in totals.columns if c not in PRICES], *[F.coalesce(f"{c}_middle", c).alias(c) for c in PRICES]
    )


def _middle_prices(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, which, middle``: the median of each of the prices whose ``<price>_open`` holds."""
    each = [*keys, "which"]
    wanted = [F.when(F.col(f"{c}_open"), F.col(c)).alias(c) for c in PRICES]
    long = pairs.select(*keys, "n", *wanted).unpivot([*keys, "n"], list(PRICES), "which", "price").where("price IS NOT NULL")
    price = F.col("price")
    cell = F.signum(price) * F.floor(F.log2(F.abs(price) + 1) * CELLS_PER_DOUBLING)
    counts = long.groupBy(*each, cell.cast("bigint").alias("cell"), "price").agg(F.sum("n").alias("n"))
    in_order = Window.partitionBy(*each).orderBy("cell")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, upto, n = F.col("total"), F.col("upto"), F.col("n")
    low, high = _low_rank(total), _high_rank(total)
    middle_cells = (
        long.groupBy(*each, cell.cast("bigint").alias("cell"))
        .agg(F.sum("n").alias("n"))
        .select(
            *each,
            "cell",
            "n",
            F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
            F.sum("n").over(everything).alias("total"),
        )
        .where(_holds(low, upto, n) | _holds(high, upto, n))
        .select(*each, "cell", "total", (upto - n).alias("before"))
    )
    inside = Window.partitionBy(*each, "cell").orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(middle_cells, [*each, "cell"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))
    ends = [F.max(F.when(_holds(rank, upto, n), price)) for rank in (low, high)]
    return ranked.groupBy(*each).agg(half_up((ends[0] + ends[1]) / 2).alias("middle"))


def merge_duplicate_days(daily: DataFrame, series: str = "barcode") -> DataFrame:
    """One row per series and day where a product was sold under several barcodes.

    Quantities and totals add up, the promotion flag is kept if any row has it,
    prices and rates are averaged. Days are combined before they are shuffled;
    then the series, at most one calendar long each, go to the partitions that
    the calendar and feature windows after this step need anyway.
    """

    def total_units(c: str) -> Column:
        whole, rest = exact_parts(daily, c)
        return units(F.sum(whole), F.sum(rest), DAILY_SCALE)

    def total(c: str) -> Column:
        return total_units(c) / F.lit(float(DAILY_SCALE))

    def mean_of(c: str) -> Column:
        return total_units(c) / (F.count(F.lit(1)) * F.lit(float(DAILY_SCALE)))

    merged = daily.groupBy(series, "date").agg(
        F.min("product_code").alias("product_code"),
        F.max("on_promotion").alias("on_promotion"),
        total("quantity").alias("quantity"),
        total("returned_quantity").alias("returned_quantity"),
        mean_of("unit_value").alias("unit_value"),
        mean_of("discount").alias("discount"),
        mean_of("increase").alias("increase"),
        mean_of("cost_value").alias("cost_value"),
        total("total_value").alias("total_value"),
    )
    return by_key(merged, series)


def quality_counts(lines: DataFrame, sales: DataFrame, products: DataFrame, start: str, end: str) -> DataFrame:
    """Rows the rollup leaves out or fills in, one line of counts.

    Both join sides hold a key once, so a repeated sale or product counts no line
    twice, and each count is one partial aggregation.
    """
    days = sale_days(sales).groupBy("sale_id").agg(F.min("date").alias("date"))
    known = products.select("product_code").distinct().withColumn("_known", F.lit(1))
    joined = lines.join(days, "sale_id", "left").join(known, "product_code", "left")
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return joined.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("barcode").isNull()).alias("without_barcode"),
        F.count_if(F.col("date").isNull()).alias("without_date"),
        F.count_if(F.col("date").isNotNull() & ~inside).alias("outside_period"),
        F.count_if(F.col("_known").isNull()).alias("without_product"),
        F.count_if(F.col("quantity").isNull()).alias("without_quantity"),
        F.count_if(F.coalesce("unit_value", F.lit(0.0)) <= 0).alias("without_price"),
        F.count_if(F.coalesce("unit_value", F.lit(0.0)) < F.coalesce("cost_value", F.lit(0.0))).alias("below_cost"),
    )

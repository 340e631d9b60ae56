"""Gap-free daily series and holiday flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.session import broadcast_up_to, by_key

CARRIED = ("product_code", "unit_value", "cost_value")
ZEROED = ("on_promotion", "quantity", "returned_quantity", "discount", "increase", "total_value")

# Brazilian national holidays with a fixed date, and the local one on 18 October.
NATIONAL_HOLIDAYS = (
    (1, 1, "New year"),
    (4, 21, "Tiradentes' Day"),
    (5, 1, "Labour Day"),
    (9, 7, "Independence Day"),
    (10, 12, "Our Lady of Aparecida"),
    (11, 2, "All Souls' Day"),
    (11, 15, "Republic Day"),
    (12, 25, "Christmas Day"),
)
LOCAL_HOLIDAYS = ((10, 18, "Local holiday"),)

# More days than any real holiday calendar; a larger table is joined by shuffle.
MAX_BROADCAST_HOLIDAYS = 100_000


def fill_calendar(
    daily: DataFrame, start: str, end: str, series: str = "barcode", wanted: DataFrame | None = None
) -> DataFrame:
    """Every day from the first sale of a series up to ``end``.

    Each sale day is stretched to the eve of the next one, which carries its
    prices forward without a calendar table and a join back to it: one shuffle
    on the series key serves this step and all row-ordered features after it.
    Movements are 0 on the added days.

    ``wanted`` (``series``, ``product_code``) adds products that never sold: they
    get the whole period with zeros.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    sold = daily.where(F.col("date").between(first, last)).select(
        series, "date", *CARRIED, *ZEROED, F.lit(False).alias("_seed")
    )
    if wanted is not None:
        # One empty row per product on the first day. It sorts before any sale and
        # is dropped as soon as a row follows, so no join tells who never sold.
        seeds = by_key(wanted, series).groupBy(series).agg(F.min("product_code").alias("product_code"))
        empty = [c for c in (*CARRIED, *ZEROED) if c != "product_code"]
        sold = sold.unionByName(
            seeds.select(
                series,
                first.alias("date"),
                "product_code",
                *[F.lit(None).cast(sold.schema[c].dataType).alias(c) for c in empty],
                F.lit(True).alias("_seed"),
            )
        )
    order = Window.partitionBy(series).orderBy("date", F.desc("_seed"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead("date").over(order)
    stretched = (
        sold.select(
            series,
            F.col("date").alias("_sold"),
            *[F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.lit(0)).alias(c) for c in CARRIED],
            *ZEROED,
            "_seed",
            following.alias("_next"),
        )
        .where(~F.col("_seed") | F.col("_next").isNull())
        .withColumn("_until", F.coalesce(F.date_sub("_next", 1), last))
        .withColumn("date", F.explode(F.sequence("_sold", "_until", F.expr("interval 1 day"))))
    )
    on_sale_day = F.col("date") == F.col("_sold")
    return stretched.select(
        series,
        "date",
        *CARRIED,
        *[
            F.when(on_sale_day, F.coalesce(c, F.lit(0))).otherwise(F.lit(0)).cast(sold.schema[c].dataType).alias(c)
            for c in ZEROED
        ],
    )


def holiday_dates(
    spark: SparkSession,
    first_year: int,
    last_year: int,
    rules: Iterable[tuple[int, int, str]] = NATIONAL_HOLIDAYS,
) -> DataFrame:
    """Holiday table (``date``, ``name``) from month and day rules.

    One year more than asked for, so that 31 December knows the next new year.
    """
    rows = [F.struct(F.lit(m).alias("month"), F.lit(d).alias("day"), F.lit(n).alias("name")) for m, d, n in rules]
    return (
        spark.range(1)
        .select(F.inline(F.array(*rows)))
        .withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year + 1))))
        .select(F.make_date("year", "month", "day").alias("date"), "name")
    )


def flag_holidays(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add ``holiday`` and ``holiday_eve``.

    Both flags come from one lookup table with a row for each holiday and each
    day before one.
    """
    on = holidays.select("date", F.lit(1).alias("holiday"), F.lit(0).alias("holiday_eve"))
    eve = holidays.select(F.date_sub("date", 1).alias("date"), F.lit(0).alias("holiday"), F.lit(1).alias("holiday_eve"))
    lookup = on.unionByName(eve).groupBy("date").agg(F.max("holiday").alias("holiday"), F.max("holiday_eve").alias("holiday_eve"))
    return (
        df.join(broadcast_up_to(lookup, MAX_BROADCAST_HOLIDAYS), "date", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("holiday", "holiday_eve")})
    )


def _on_rules(rules: Iterable[tuple[int, int, str]], date: Column) -> Column:
    return (F.month(date) * 100 + F.dayofmonth(date)).isin([month * 100 + day for month, day, _ in rules])


def flag_rules(df: DataFrame, rules: Iterable[tuple[int, int, str]] = NATIONAL_HOLIDAYS) -> DataFrame:
    """The flags of ``flag_holidays`` straight from month and day rules, without a table."""
    rules = list(rules)
    return df.withColumns(
        {
            "holiday": _on_rules(rules, F.col("date")).cast("int"),
            "holiday_eve": _on_rules(rules, F.date_add("date", 1)).cast("int"),
        }
    )


def override_holidays(
    df: DataFrame, rules: Iterable[tuple[int, int, str]] = LOCAL_HOLIDAYS, date: str = "date", holiday: str = "holiday"
) -> DataFrame:
    """Set the flag on extra month and day pairs; column names match in any case."""
    hit = _on_rules(rules, F.col(date))
    flag = next(c for c in df.columns if c.lower() == holiday.lower())
    return df.withColumn(flag, F.when(hit, F.lit(1)).otherwise(F.col(flag)))


def overridden_rows(
    df: DataFrame, rules: Iterable[tuple[int, int, str]] = LOCAL_HOLIDAYS, date: str = "date"
) -> DataFrame:
    """How many rows each rule of ``override_holidays`` touches."""
    return df.agg(
        *[
            F.count_if(_on_rules([rule], F.col(date))).alias(f"rows_{rule[0]:02d}_{rule[1]:02d}")
            for rule in rules
        ]
    )


def calendar_columns(df: DataFrame) -> DataFrame:
    """Weekend flag, day of the week and week of the month of each day."""
    date = F.col("date")
    return df.withColumns(
        {
            "weekend": dates.is_weekend(date),
            "day_of_week": dates.day_of_week(date),
            "week_of_month": dates.week_of_month(date),
        }
    )

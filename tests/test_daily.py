"""Rollup, calendar and holidays on small hand-computed frames."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import calendar, rollup
from shelfcast.sinks.tables import export_series


def day(n, month=1, year=2024):
    return dt.date(year, month, n)


def store(spark, rows, products=((1, "7000001"),)):
    """rows: (sale day, product, barcode, promo, qty, returned, price, cost, discount, increase)"""
    sales = spark.createDataFrame(
        [(i, dt.datetime.combine(r[0], dt.time(23, 30))) for i, r in enumerate(rows)], schemas.SALES
    )
    lines = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], schemas.LINES)
    return sales, lines, spark.createDataFrame(list(products), schemas.PRODUCTS)


def rolled(spark, rows, start="2024-01-01", end="2024-12-31", wanted=None, **kw):
    sales, lines, products = store(spark, rows, **kw)
    return rollup.daily_sales(lines, sales, products, start, end, wanted)


def test_daily_rollup(spark):
    d = day(3)
    rows = [
        (d, 1, "a", 0, 1.6, 0.0, 2.0, 1.0, 0.10, 0.0),
        (d, 1, "a", 1, 2.7, 1.0, 4.0, 1.0, None, 0.0),
        (d, 1, "a", None, None, None, None, None, 0.20, None),
    ]
    r = rolled(spark, rows).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.date, r.product_code, r.barcode, r.line_barcode) == (d, 1, "7000001", "a")
    assert (r.on_promotion, r.quantity, r.returned_quantity) == (1, 4.0, 1.0)
    assert (r.unit_value, r.cost_value, r.discount, r.increase, r.total_value) == (2.0, 1.0, 0.1, 0.0, 8.0)


def test_even_count_takes_the_mean_of_the_middle(spark):
    rows = [(day(1), 1, "a", 0, 1.0, 0.0, p, p, 0.0, 0.0) for p in (1.0, 8.0, 2.0, 4.0)]
    assert rolled(spark, rows).first().unit_value == 3.0


def test_published_totals(spark):
    rows = [(day(1), 1, "a", 0, 17.0, 0.0, 9.95, 5.0, 0.0, 0.0), (day(2), 1, "a", 0, 30.0, 0.0, 9.95, 5.0, 0.0, 0.0)]
    assert [r.total_value for r in rolled(spark, rows).orderBy("date").collect()] == [169.15, 298.5]


def test_sum_of_fractions_is_not_cut_short(spark):
    rows = [(day(1), 1, "a", 0, q, 0.0, 1.0, 1.0, 0.0, 0.0) for q in [0.1] * 10]
    assert rolled(spark, rows).first().quantity == 1.0


def test_filters(spark):
    good = (day(31, 12), 1, "a", 0, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0)
    rows = [
        good,
        (day(31, 12, 2023), *good[1:]),
        (day(5), 1, None, *good[3:]),
        (day(5), 9, *good[2:]),
        (day(6), 2, *good[2:]),
    ]
    products = ((1, "7000001"), (2, "7000002"))
    got = rolled(spark, rows, products=products).select("date", "product_code").collect()
    assert {tuple(r) for r in got} == {(day(31, 12), 1), (day(6), 2)}
    wanted = spark.createDataFrame([(2,), (2,)], "product_code bigint")
    got = rolled(spark, rows, products=products, wanted=wanted).select("product_code").collect()
    assert [r.product_code for r in got] == [2]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 3), st.integers(1, 400), st.integers(1, 5)), min_size=1, max_size=40
    )
)
def test_median_is_exact(spark, lines):
    rows = [(day(d), 1, "a", 0, 1.0, 0.0, p / 4, float(c), 0.0, 0.0) for d, p, c in lines]
    for split in (False, True):
        sales, line_table, products = store(spark, rows)
        got = rollup.daily_sales(line_table, sales, products, "2024-01-01", "2024-12-31", split_hot=split)
        got = {r.date.day: (r.unit_value, r.cost_value) for r in got.collect()}
        for d in {x[0] for x in lines}:
            price = statistics.median(p / 4 for x, p, _ in lines if x == d)
            cost = statistics.median(float(c) for x, _, c in lines if x == d)
            assert got[d] == pytest.approx((round(price + 1e-9, 3), cost), abs=1e-3)


def test_hot_day_is_the_same_when_split(spark):
    hot = spark.range(20_000).select(
        F.col("id").alias("sale_id"),
        F.lit(1).cast("bigint").alias("product_code"),
        F.lit("a").alias("barcode"),
        F.lit(0).alias("on_promotion"),
        (F.col("id") % 7).cast("double").alias("quantity"),
        F.lit(0.0).alias("returned_quantity"),
        (F.pmod(F.hash("id"), F.lit(100_000)) / 1000.0).alias("unit_value"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(1000)) / 100.0).alias("cost_value"),
        F.lit(0.05).alias("discount"),
        F.lit(0.01).alias("increase"),
    )
    sales = spark.range(20_000).select(F.col("id").alias("sale_id"), F.lit("2024-05-05 10:00:00").cast("timestamp_ntz").alias("sold_at"))
    products = spark.createDataFrame([(1, "7000001")], schemas.PRODUCTS)
    plain, split = (
        rollup.daily_sales(hot, sales, products, "2024-01-01", "2024-12-31", split_hot=s).collect() for s in (False, True)
    )
    assert plain == split
    assert plain[0].unit_value == pytest.approx(hot.agg(F.median("unit_value")).first()[0], abs=1e-3)


def test_only_days_with_several_prices_are_searched(spark, monkeypatch):
    rows = [(day(d), p, "a", 0, 1.0, 0.0, 2.0 + p, 1.0 + (k if d == 3 else 0), 0.0, 0.0) for d in (1, 2, 3) for p in (1, 2) for k in range(5)]
    searched, search = [], rollup._middle_prices
    monkeypatch.setattr(rollup, "_middle_prices", lambda pairs, keys: searched.append(pairs) or search(pairs, keys))
    sales, lines, _ = store(spark, rows)
    sold = lines.join(rollup.sale_days(sales), "sale_id")
    keys = ["date", "product_code", "barcode"]
    split = rollup.split_median_days(sold, keys)
    assert {r.date for r in searched[0].collect()} == {day(3)}
    plain = rollup.median_days(sold, keys).select(split.columns)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


def test_lines_move_once_to_their_day(spark):
    rows = [(day(1), 1, "a", 0, 1.0, 0.0, p, p, 0.0, 0.0) for p in (1.0, 8.0)]
    sales, lines, _ = store(spark, rows)
    sold = lines.join(F.broadcast(rollup.sale_days(sales)), "sale_id")
    plan = rollup.median_days(sold, ["date", "product_code", "barcode"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_duplicate_days(spark):
    rows = [
        (day(1), 1, "a", 0, 3.0, 0.0, 2.0, 1.0, 0.1, 0.0),
        (day(1), 1, "b", 1, 4.0, 1.0, 4.0, 3.0, 0.2, 0.0),
    ]
    r = rollup.merge_duplicate_days(rolled(spark, rows)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.quantity, r.on_promotion, r.unit_value, r.cost_value, r.total_value) == (7.0, 1, 3.0, 2.0, 22.0)
    assert (r.returned_quantity, r.discount) == (1.0, 0.15)


def dense(spark, rows, start, end, wanted=None):
    return calendar.fill_calendar(rollup.merge_duplicate_days(rolled(spark, rows)), start, end, wanted=wanted)


def test_calendar_is_filled_from_the_first_sale(spark):
    rows = [(day(3), 1, "a", 1, 5.0, 0.0, 2.0, 1.0, 0.1, 0.2), (day(6), 1, "a", 0, 1.0, 0.0, 3.0, 1.5, 0.0, 0.0)]
    got = dense(spark, rows, "2024-01-01", "2024-01-07").orderBy("date").collect()
    assert [r.date for r in got] == [day(n) for n in range(3, 8)]
    assert [r.quantity for r in got] == [5.0, 0.0, 0.0, 1.0, 0.0]
    assert [r.unit_value for r in got] == [2.0, 2.0, 2.0, 3.0, 3.0]
    assert [r.cost_value for r in got] == [1.0, 1.0, 1.0, 1.5, 1.5]
    assert [r.on_promotion for r in got] == [1, 0, 0, 0, 0]
    assert {r.product_code for r in got} == {1}


def test_unsold_products_have_the_whole_period(spark):
    rows = [(day(1), 1, "a", 0, 5.0, 0.0, 2.0, 1.0, 0.0, 0.0), (day(4), 2, "b", 0, 2.0, 0.0, 2.0, 1.0, 0.0, 0.0)]
    wanted = spark.createDataFrame([("7000001", 1), ("7000002", 2), ("7000003", 3)], "barcode string, product_code bigint")
    merged = rollup.merge_duplicate_days(rolled(spark, rows, products=((1, "7000001"), (2, "7000002"))))
    got = calendar.fill_calendar(merged, "2024-01-01", "2024-01-07", wanted=wanted).collect()
    by = {b: [r for r in got if r.barcode == b] for b in ("7000001", "7000002", "7000003")}
    assert {b: len(r) for b, r in by.items()} == {"7000001": 7, "7000002": 4, "7000003": 7}
    assert all(r.quantity == 0 and r.unit_value == 0 and r.product_code == 3 for r in by["7000003"])
    assert sum(r.quantity for r in by["7000001"]) == 5.0


def test_holidays(spark):
    days = [day(25, 12), day(24, 12), day(31, 12), day(18, 10), day(2, 1)]
    df = spark.createDataFrame([(d, 1) for d in days], "date date, x int")
    table = calendar.holiday_dates(spark, 2024, 2024)
    for flagged in (calendar.flag_holidays(df, table), calendar.flag_rules(df)):
        got = {r.date: (r.holiday, r.holiday_eve) for r in flagged.collect()}
        assert got == {days[0]: (1, 0), days[1]: (0, 1), days[2]: (0, 1), days[3]: (0, 0), days[4]: (0, 0)}
    over = calendar.override_holidays(calendar.flag_rules(df))
    assert {r.date for r in over.where("holiday = 1").collect()} == {days[0], days[3]}
    assert calendar.overridden_rows(df).first().rows_10_18 == 1


def test_holiday_column_is_found_in_any_case(spark):
    df = spark.createDataFrame([(day(18, 10), 0)], "Date date, HOLIDAY int")
    assert calendar.override_holidays(df, date="date", holiday="Holiday").first().HOLIDAY == 1


def test_export_names(spark):
    rows = [(day(3), 1, "a", 1, 5.0, 0.0, 2.0, 1.0, 0.1, 0.2)]
    out = export_series(calendar.flag_rules(dense(spark, rows, "2024-01-01", "2024-01-04")))
    assert out.columns == schemas.SERIES_FILE.names


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 31), st.integers(1, 2), st.integers(1, 9)), min_size=1, max_size=25))
def test_dense_series_has_no_gaps_and_keeps_quantities(spark, sold):
    rows = [(day(d), p, f"b{p}", 0, float(q), 0.0, 1.0, 1.0, 0.0, 0.0) for d, p, q in sold]
    merged = rollup.merge_duplicate_days(rolled(spark, rows, products=((1, "7000001"), (2, "7000002"))))
    got = calendar.fill_calendar(merged, "2024-01-01", "2024-02-10").collect()
    for p in {x[1] for x in sold}:
        series = sorted(r.date for r in got if r.barcode == f"700000{p}")
        first = min(day(d) for d, x, _ in sold if x == p)
        assert series == [first + dt.timedelta(n) for n in range((day(10, 2) - first).days + 1)]
        assert sum(r.quantity for r in got if r.barcode == f"700000{p}") == sum(q for _, x, q in sold if x == p)


def test_text_dates(spark):
    sales = spark.createDataFrame([(1, "2024-01-03 10:00:00"), (2, "2024-01-04"), (3, "soon")], "sale_id bigint, sold_at string")
    assert {r.sale_id: r.date for r in rollup.sale_days(sales).collect()} == {1: day(3), 2: day(4), 3: None}
    one = (1, "a", 0, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0)
    lines = spark.createDataFrame([(1, *one), (3, *one), (9, *one)], schemas.LINES)
    products = spark.createDataFrame([(1, "7000001")], schemas.PRODUCTS)
    q = rollup.quality_counts(lines, sales, products, "2024-01-01", "2024-12-31").first()
    assert (q.lines, q.without_date, q.outside_period) == (3, 2, 0)


def test_sums_are_exact_and_rounding_has_no_limit(spark):
    from pyspark.sql import functions as F

    from shelfcast.functions.numeric import half_up
    from shelfcast.operators import rollup

    schema = "sale_id long, product_code long, barcode string, on_promotion int, quantity double, returned_quantity double, "
    schema += "unit_value double, cost_value double, discount double, increase double"
    rows = [(1, 1, "b", 0, 0.33334, 0.0, 2.0, 1.0, 0.0, 0.0)] * 3 + [(1, 2, "c", 0, float("nan"), None, 5.0, float("nan"), 0.1, 0.0)]
    sales = spark.createDataFrame([(1, "2024-01-02"), (1, "2024-01-02")], "sale_id long, sold_at string")
    products = spark.createDataFrame([(1, "b"), (2, "c")], "product_code long, barcode string")
    lines = spark.createDataFrame(rows, schema)
    once = rollup.daily_sales(lines, sales.distinct(), products, "2024-01-01", "2024-12-31").collect()
    got = {r.product_code: r for r in once}
    assert got[1].quantity == 1.0 and got[1].total_value == 2.0
    assert got[2].quantity == 0.0 and got[2].cost_value == 0.0 and got[2].discount == 0.1
    assert rollup.quality_counts(lines, sales, products, "2024-01-01", "2024-12-31").first().lines == 4
    values = [(2.5e13, 6), (1.8e16, 3), (-1.8e16, 3), (2.4999, 2), (-0.0005, 3), (9.3e18, 6)]
    for value, digits in values:
        rounded = spark.range(1).select(half_up(F.lit(value), digits)).first()[0]
        assert rounded == pytest.approx(value, abs=0.5 * 10**-digits, rel=1e-15)
    assert spark.range(1).select(half_up(F.lit(None).cast("double"))).first()[0] is None


def test_days_are_combined_before_the_series_shuffle(spark):
    from shelfcast.operators import rollup

    columns = "product_code long, on_promotion int, quantity double, returned_quantity double, unit_value double, "
    columns += "cost_value double, discount double, increase double, total_value double"
    daily = spark.createDataFrame([], f"barcode string, date date, {columns}")
    plan = rollup.merge_duplicate_days(daily)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("REPARTITION_BY_NUM") < plan.index("partial_")  # the tree is printed from its top

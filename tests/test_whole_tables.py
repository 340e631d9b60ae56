"""Queries over the whole tables: no line, day or month is filtered away."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import demand, queries
from shelfcast.sources import star

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PERIOD = 2192

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_calendar_holds_all_sales_and_codes_never_sold(spark):
    got = queries.REGISTRY["calendar_assortment"](spark, FOLDER)
    sold = demand.merged(star.open_store(spark, FOLDER)).agg(F.sum("quantity")).first()[0]
    assert got.agg(F.sum("quantity")).first()[0] == sold > 0
    unsold = {r.barcode: r.n for r in got.groupBy("barcode").agg(F.count("*").alias("n"), F.sum("quantity").alias("q")).collect() if not r.q}
    assert len(unsold) == star.table(spark, FOLDER, "supplier").count() and set(unsold.values()) == {PERIOD}


def test_rows_per_series_of_codes_never_sold(spark):
    rows = queries.REGISTRY["rows_per_series_assortment"](spark, FOLDER).collect()
    unsold = [r for r in rows if r.barcode.startswith("2")]
    assert len(unsold) == star.table(spark, FOLDER, "supplier").count()
    assert all((r.days, r.complete_rows) == (PERIOD, 0) for r in unsold)
    assert all(r.complete_rows > 0 for r in rows if r not in unsold)


def test_models_differ_in_coverage_by_themselves(spark):
    got = queries.REGISTRY["compare_merge_coverage"](spark, FOLDER)
    all_days = demand.dense(star.open_store(spark, FOLDER)).groupBy("barcode").count().collect()
    n = got.agg(F.count("naive").alias("naive"), F.count("mean7").alias("mean7"), F.count("*").alias("rows")).first()
    assert n.naive == n.rows == sum(r["count"] - 1 for r in all_days)
    assert n.mean7 == demand.model_inputs(star.open_store(spark, FOLDER)).count() < n.naive

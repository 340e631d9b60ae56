"""Every registered query against its SQL in DuckDB."""

import os
from pathlib import Path

import pytest

import oracle_check
from shelfcast.plans.oracle import oracle_sql
from shelfcast.plans.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(REGISTRY)
    assert set(REGISTRY) - set(ORACLE) == {
        "backtest_ridge",
        "backtest_sequence",
        "forecast_gbt",
        "forecast_sequence",
        "forecast_walk_forward",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    assert oracle_check.differences(REGISTRY[name](spark, FOLDER), duck, ORACLE[name]) == []

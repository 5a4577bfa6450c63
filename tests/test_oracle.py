"""Every registered query against its DuckDB SQL on the smallest test data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification import oracle as sql
from verification.compare import difference, open_oracle
from verification.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(sql.oracle_sql())
    assert set(REGISTRY) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_oracle(spark, oracle, name):
    assert difference(REGISTRY[name](spark, FOLDER), oracle, sql.oracle_sql()[name]) is None


def test_preview_has_ten_rows(spark):
    assert REGISTRY["t4k_preview"](spark, FOLDER).count() == 10


def test_entry(spark):
    assert {row["region"] for row in entry(spark).collect()} <= {"North America", "LATAM", "APAC", "EMEA", "Other"}


def test_order_grain_golden(spark):
    """Regional order-grain sales at sf0.01 add up to the non-cancelled order total."""
    sales = REGISTRY["g6b_sales_region_order_grain"](spark, "/root/testdata/sf0.01").collect()
    assert round(sum(row["total_sales"] for row in sales), 2) == 2485039865.74

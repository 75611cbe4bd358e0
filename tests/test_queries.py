"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry
from checks.oracle import ORACLE
from checks.queries import REGISTRY
from compare import TABLES, same_rows
from helpers import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, database, name):
    result = REGISTRY[name](spark, SF_DIR)
    cursor = database.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    difference = same_rows(result.columns, [tuple(r) for r in result.collect()],
                           columns, cursor.fetchall())
    assert not difference


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["area", "area_level", "click_product_id", "city_infos", "click_count",
                              "product_name", "product_status"]
    assert result.count() == 21


@pytest.mark.parametrize("name", ["category_full_counts", "top10_categories"])
def test_sessions_and_categories_come_from_one_scan(spark, name):
    assert plan_of(REGISTRY[name](spark, SF_DIR), "simple").count("lineitem.parquet") == 1

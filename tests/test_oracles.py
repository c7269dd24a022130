"""Every registered query against its SQL, on the smallest data."""

import os

import pytest
from check_oracles import compare, database

import __spark_entry__ as entry
from reelhouse.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# A plan listed under several names is run once.
DISTINCT = list({id(plan): name for name, plan in reversed(QUERIES.items())}.values())


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", DISTINCT)
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, name, SF_DIR)
    assert result.startswith(("ok", "rows only")), result
    if name in ORACLES:
        assert result.split(") ")[-1] == "", f"column types differ: {result}"


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "avg_rating"]
    assert df.count() > 0


def test_no_query_goes_without_sql():
    assert set(QUERIES) == set(ORACLES)

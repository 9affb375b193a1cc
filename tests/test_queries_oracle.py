"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql
from lakeward.queries import QUERIES
from oracle_harness import compare, duck

SF_DIR = os.environ.get("LAKEWARD_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF_DIR, QUERIES[name], oracle_sql().get(name))
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["pipeline_name", "update_id", "run_timestamp", "run_date", "table_name",
                          "expectation", "passed_records", "failed_records", "fail_pct"]
    assert df.count() == 25

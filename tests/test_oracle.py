"""Every registered query against its SQL, over whole tables.

Set ``ORACLE_SF_DIR`` to compare at another scale.
"""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, duckdb_result, spark_result

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_core_query_has_sql():
    assert set(contract.core_queries()) == set(contract.core_oracle_sql())


@pytest.mark.parametrize("name", list(contract.core_queries()))
def test_query_matches_sql(spark, con, name):
    schema, rows = spark_result(contract.core_queries()[name](spark, FOLDER))
    expected_schema, expected = duckdb_result(con, contract.core_oracle_sql()[name])
    assert schema == expected_schema
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0

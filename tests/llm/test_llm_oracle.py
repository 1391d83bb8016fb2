"""Queries that SQL can express, against their SQL over whole tables."""

import os

import pytest

from compare import connect, duckdb_result, spark_result
from landfall.llm import queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    schema, rows = spark_result(queries.QUERIES[name](spark, FOLDER))
    expected_schema, expected = duckdb_result(connect(FOLDER), queries.ORACLE[name])
    assert schema == expected_schema
    assert rows == expected
    assert rows

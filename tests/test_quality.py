"""The checks and their error."""

import logging

import pytest

from landfall.operators import DataQualityError, TableRule, enforce, quality_report


@pytest.fixture()
def tables(spark):
    return {
        "good": spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"),
        "empty": spark.createDataFrame([], "id int"),
        "nulls": spark.createDataFrame([(None, "a"), (1, None), (1, None)], "id int, name string"),
    }


def test_report_lines(tables):
    rules = [
        TableRule("good", ("id",), unique=True),
        TableRule("empty", ("id",)),
        TableRule("nulls", ("id", "name"), unique=True),
    ]
    lines = {
        (r.table_name, r.check_name, r.column_name): (r.passed, r.bad_rows)
        for r in quality_report(tables, rules).collect()
    }
    assert lines == {
        ("good", "not_empty", None): (True, 0),
        ("good", "not_null", "id"): (True, 0),
        ("good", "unique", "id"): (True, 0),
        ("empty", "not_empty", None): (False, 0),
        ("empty", "not_null", "id"): (True, 0),
        ("nulls", "not_empty", None): (True, 0),
        ("nulls", "not_null", "id"): (False, 1),
        ("nulls", "not_null", "name"): (False, 2),
        ("nulls", "unique", "id, name"): (False, 1),
    }


def test_all_failures_are_reported_by_default(tables):
    rules = [TableRule("empty"), TableRule("nulls", ("id",)), TableRule("good", ("id",))]
    with pytest.raises(DataQualityError) as error:
        enforce(tables, rules)
    assert [(f.table_name, f.check_name) for f in error.value.failures] == [
        ("empty", "not_empty"),
        ("nulls", "not_null"),
    ]
    assert "key id" in str(error.value) and "table empty" in str(error.value)


def test_fail_fast_stops_at_the_first(tables):
    rules = [TableRule("nulls", ("id", "name")), TableRule("empty")]
    with pytest.raises(DataQualityError) as error:
        enforce(tables, rules, fail_fast=True)
    assert len(error.value.failures) == 1


def test_success_is_logged(tables, caplog):
    with caplog.at_level(logging.INFO, logger="landfall.quality"):
        report = enforce(tables, [TableRule("good", ("id",))])
    assert len(report) == 2
    assert "passed: not_null good id" in caplog.text


def test_nulls_of_all_keys_take_one_pass(tables):
    plan = quality_report(tables, [TableRule("nulls", ("id", "name"))])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") == 1

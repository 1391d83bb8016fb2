"""Column functions on edge values, and against plain restatements of their rules."""

import datetime
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall import functions as fn

PROPERTY = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
TEXTS = st.lists(st.none() | st.text(max_size=30), min_size=1, max_size=40)


def apply(spark, function, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [row.out for row in df.select("i", function("v").alias("out")).orderBy("i").collect()]


def test_clean_code_drops_lower_case(spark):
    values = ["B-1", "b1_B1", "Brand#17", None]
    assert apply(spark, fn.clean_code, values, "string") == ["B1", "1B1", "B17", None]


def test_clean_state_code(spark):
    assert apply(spark, fn.clean_state_code, ["N.Y.1", "ny"], "string") == ["NY", ""]


def test_clean_city_text(spark):
    values = ["ST. PAUL, O'HARE/X - (BPS)"]
    assert apply(spark, fn.clean_city_text, values, "string") == ["ST PAUL, OHAREX  (BPS)"]


def test_clean_state_text(spark):
    assert apply(spark, fn.clean_state_text, ["N. Car, 2"], "string") == ["N Car 2"]


def test_collapse_spaces_is_one_pass(spark):
    values = ["A    B", " A  B "]
    assert apply(spark, fn.collapse_spaces, values, "string") == ["A  B", "A B"]


def test_collapse_all_spaces(spark):
    every = lambda c: fn.collapse_spaces(c, collapse_all=True)
    assert apply(spark, every, ["A    B"], "string") == ["A B"]


def test_ascii_only(spark):
    values = ["a b’c\U0001f600d", None]
    assert apply(spark, fn.ascii_only, values, "string") == ["abcd", None]


def test_day_number_to_date(spark):
    values = [0.0, 20454.0, 20454.9, -1.0, None, 1e9]
    expected = ["1960-01-01", "2016-01-01", "2016-01-01", "1959-12-31", None, None]
    assert apply(spark, fn.day_number_to_date, values, "double") == expected


def test_age_bounds(spark):
    ages = [None, 0, -1, 1, 12, 13, 18, 19, 64, 65]
    bands = (
        "NA NA infant children children teens teens adult adult elderly".split()
    )
    assert apply(spark, fn.age_group, ages, "int") == bands


def test_age_zero_as_infant(spark):
    zero = lambda c: fn.age_group(c, zero_is_infant=True)
    assert apply(spark, zero, [None, 0, 1], "int") == ["NA", "infant", "children"]


def test_date_parts(spark):
    dates = ["2016-01-01", "2016-02-29", None]
    assert apply(spark, fn.day_of_month, dates, "string") == [1, 29, None]
    assert apply(spark, fn.weekday_name, dates, "string") == ["Fri", "Mon", None]


def test_to_int_gives_null_for_bad_numbers(spark):
    values = [1.9, -1.9, float("nan"), 3e9, None]
    assert apply(spark, fn.to_int, values, "double") == [1, -1, None, None, None]


def test_text_to_int(spark):
    values = ["24", "24.9", "-3", "+3", "x", "", " 5", "1e3", "99999999999", "5\n", None]
    expected = [24, 24, -3, 3, None, None, 5, 1000, None, 5, None]
    assert apply(spark, fn.text_to_int, values, "string") == expected
    padded = ["\t582 ", "209\u00a0", " \u20031.5\n", "1,200", "12,00", "1,234,567.9", ".5", "1 2", "NaN"]
    assert apply(spark, fn.text_to_int, padded, "string") == [
        582, 209, 1, 1200, None, 1234567, 0, None, None,
    ]
    assert apply(spark, fn.text_to_double, padded, "string") == [
        582.0, 209.0, 1.5, 1200.0, None, 1234567.9, 0.5, None, None,
    ]


def test_mode_and_visa_category(spark):
    codes = [1, 2, 3, 9, 4, None]
    modes = ["Air", "Sea", "Land", "Not reported", None, None]
    assert apply(spark, fn.decode_mode, codes, "int") == modes
    visas = ["Business", "Pleasure", "Student", None, None, None]
    assert apply(spark, fn.decode_visa_category, codes, "int") == visas
    assert apply(spark, fn.decode_mode, [1.0, 9.0], "double") == ["Air", "Not reported"]


@pytest.mark.parametrize(
    "label, city, state",
    [
        ("ALCAN, AK   ", "ALCAN", "AK"),
        ("BOGOTA, EL DORADO #ARPT, COLOMBIA", "BOGOTA, EL DORADO #ARPT", "COLOMBIA"),
        ("MARIPOSA AZ", "MARIPOSA AZ", None),
        ("A\nB, C", "A\nB", "C"),
        (None, None, None),
    ],
)
def test_port_label(spark, label, city, state):
    assert apply(spark, fn.port_label_city, [label], "string") == [city]
    assert apply(spark, fn.port_label_state, [label], "string") == [state]


def test_classify_code(spark):
    labels = [
        "ALBANIA",
        "INVALID: USSR",
        "Collapsed Curacao (should not show)",
        "No Country Code (54)",
        "No PORT Code (Y62)",
        None,
    ]
    expected = ["valid", "invalid", "collapsed", "no_code", "no_code", None]
    assert apply(spark, fn.classify_code, labels, "string") == expected


@PROPERTY
@given(values=TEXTS)
def test_cleaning_matches_python(spark, values):
    rules = {
        fn.clean_code: "[^A-Z0-9]",
        fn.clean_state_code: "[^A-Z]",
        fn.clean_city_text: "[^A-Z,a-z ()0-9]",
        fn.clean_state_text: "[^A-Za-z 0-9]",
        fn.ascii_only: "[^\\x00-\\x7F]",
    }
    values = [v for v in values if v is None or not re.search("[\ud800-\udfff]", v)] or [None]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v string")
    cleaned = df.select(*[f("v").alias(str(i)) for i, f in enumerate(rules)], "i").orderBy("i")
    result = [tuple(row)[:-1] for row in cleaned.collect()]
    assert result == [
        tuple(None if v is None else re.sub(unwanted, "", v) for unwanted in rules.values())
        for v in values
    ]


@PROPERTY
@given(values=st.lists(st.text(alphabet="ab ", max_size=12), min_size=1, max_size=40))
def test_collapse_matches_python(spark, values):
    expected = [v.replace("  ", " ").strip(" ") for v in values]
    assert apply(spark, fn.collapse_spaces, values, "string") == expected


@PROPERTY
@given(values=st.lists(st.integers(-715509, 2936549), min_size=1, max_size=60))
def test_dates_match_python(spark, values):
    start = datetime.date(1960, 1, 1)
    days = [start + datetime.timedelta(days=v) for v in values]
    texts = apply(spark, fn.day_number_to_date, values, "int")
    assert texts == [d.isoformat() for d in days]
    assert apply(spark, fn.day_of_month, texts, "string") == [d.day for d in days]
    names = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert apply(spark, fn.weekday_name, texts, "string") == [names[d.weekday()] for d in days]


@PROPERTY
@given(values=st.lists(st.none() | st.integers(-5, 120), min_size=1, max_size=60))
def test_ages_match_python(spark, values):
    bands = [(1, "infant"), (13, "children"), (19, "teens"), (65, "adult"), (999, "elderly")]

    def band(age):
        return next(name for limit, name in bands if age < limit) if age else "NA"

    assert apply(spark, fn.age_group, values, "int") == [band(v) for v in values]


def test_functions_need_no_python_worker(spark):
    df = spark.createDataFrame([("a", 1)], "t string, n int")
    every = df.select(
        fn.ascii_only("t"), fn.day_number_to_date("n"), fn.age_group("n"), fn.clean_code("t")
    )
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert df.select(F.lit(1)).count() == 1

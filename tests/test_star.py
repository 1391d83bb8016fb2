"""Fact, dimensions and summaries: one case per rule that is easy to get wrong."""

import re

import pytest

from landfall.operators import NonUniqueKeyError, decode, enrich, first_per_key, state_labels
from landfall.plans import answers, dims, stats
from landfall.plans.fact import clean_arrivals, fact_arrivals
from landfall.schemas import FACT, RAW_ARRIVALS

BASE = dict(
    i94mode=1.0,
    i94res=209.0,
    i94port="JFK",
    arrdate=20454.0,
    i94yr=2016.0,
    i94mon=1.0,
    i94bir=30.0,
    visatype="B1",
)


def arrivals(spark, *changes):
    rows = [{**BASE, **change} for change in changes]
    values = [tuple(r[n] for n in RAW_ARRIVALS.names) for r in rows]
    return spark.createDataFrame(values, RAW_ARRIVALS)


def ports(spark, *rows):
    rows = rows or [("JFK", "NEW YORK", "NY")]
    return spark.createDataFrame(list(rows), "Code string, City string, State string")


def fact(spark, *rows):
    base = dict(
        country_of_residence_cd=209,
        port_of_entry="JFK",
        visatype="B1",
        arrival_date="2016-01-01",
        arrival_date_year=2016,
        arrival_date_month=1,
        age_group="adult",
        City="NEW YORK",
        State="NY",
        count=1,
    )
    made = [{**base, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in FACT.names) for r in made], FACT)


def rows(df):
    return [tuple(row) for row in df.collect()]


def counts(spark, *changes, **options):
    clean = clean_arrivals(arrivals(spark, *changes), **options)
    return [r["count"] for r in fact_arrivals(clean, ports(spark)).collect()]


def test_equal_arrivals_count_once(spark):
    changes = [{}, {}, {"i94bir": 31.0}]
    assert counts(spark, *changes) == [2]
    assert counts(spark, *changes, dedupe=False) == [3]


def test_rows_equal_only_after_cleaning_both_count(spark):
    assert counts(spark, {"i94port": "JFK"}, {"i94port": "JFK*"}) == [2]


def test_mode_is_compared_uncast(spark):
    modes = (1.0, 1.9, 2.0, None)
    raw = arrivals(spark, *[{"i94mode": m, "i94bir": 20.0 + i} for i, m in enumerate(modes)])
    assert [r.i94bir for r in clean_arrivals(raw).collect()] == [20]


def test_zero_age_is_unknown_unless_asked(spark):
    raw = arrivals(spark, {"i94bir": 0.0})
    assert clean_arrivals(raw).first().age_group == "NA"
    assert clean_arrivals(raw, zero_is_infant=True).first().age_group == "infant"


def test_missing_date_stays_null(spark):
    raw = arrivals(spark, {"arrdate": None})
    result = fact_arrivals(clean_arrivals(raw), ports(spark)).first()
    assert result.arrival_date is None and result["count"] == 1


def test_fact_columns_and_unknown_port(spark):
    raw = arrivals(spark, {}, {"i94port": "XXX"})
    result = fact_arrivals(clean_arrivals(raw), ports(spark))
    assert result.columns == FACT.names
    assert dict(result.dtypes) == {f.name: f.dataType.simpleString() for f in FACT}
    places = {(r.port_of_entry, r.City, r.State) for r in result.collect()}
    assert places == {("JFK", "NEW YORK", "NY"), ("XXX", None, None)}


def test_first_per_key_is_the_same_every_run(spark):
    labels = [("k", f"label {i}", i) for i in range(200)] + [("k", None, 7), (None, "z", 1)]
    expected = {("k", None, 7), (None, "z", 1)}
    for n in (1, 5, 8):
        df = spark.createDataFrame(labels[::-1], "key string, label string, n int").repartition(n)
        assert set(rows(first_per_key(df, ["key"]))) == expected


def test_first_per_key_of_keys_only(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert rows(first_per_key(df, ["a", "b"])) == [(1, 2)]


def shuffled_records(df):
    """Records written by the first exchange of a query that has run."""
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    while plan.children().size() or plan.getClass().getSimpleName() == "ShuffleQueryStageExec":
        if plan.getClass().getSimpleName() == "ShuffleQueryStageExec":
            plan = plan.plan()
        if plan.getClass().getSimpleName() == "ShuffleExchangeExec":
            return plan.metrics().apply("shuffleRecordsWritten").value()
        plan = plan.children().apply(0)
    raise AssertionError("no exchange")


def test_a_hot_key_sends_one_row_per_task(spark):
    """A third of all rows share one key, and are combined before the shuffle."""
    df = spark.range(0, 90000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 50) AS k", "id AS v")
    for result in (first_per_key(df, ["k"]), df.select("k").distinct()):
        assert len(result.collect()) == 50
        assert shuffled_records(result) <= 8 * 50


def test_equal_arrivals_collapse_before_the_shuffle(spark, folder):
    arrivals(spark, {}).selectExpr("*", "explode(sequence(1, 40000)) AS n").repartition(
        8
    ).drop("n").write.parquet(folder + "/raw")
    raw = spark.read.parquet(folder + "/raw")
    clean = clean_arrivals(raw)
    assert len(clean.collect()) == 1
    assert shuffled_records(clean) <= 8


def test_first_per_key_matches_python(spark):
    data = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(3000)]
    df = spark.createDataFrame(data, "key string, v int")
    expected = {}
    for key, v in data:
        expected[key] = min(v, expected.get(key, v))
    assert dict(rows(first_per_key(df, ["key"]))) == expected


def test_dates_are_unique_over_months(spark):
    raw = arrivals(spark, {"i94mon": 1.0}, {"i94mon": 2.0, "i94bir": 40.0})
    clean = clean_arrivals(raw)
    dates = dims.dim_dates(clean)
    assert rows(dates) == [("2016-01-01", 2016, 1, 1, "Fri")]
    built = fact_arrivals(clean, ports(spark))
    assert rows(dims.dim_dates(built)) == rows(dates)
    assert rows(stats.stats_weekday(built, dates)) == [(2016, "Fri", 2)]


def before_the_first_exchange(df):
    """Names of the operators from the scan up to the first exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    names = [re.sub(r"^[\s:+*()0-9-]*", "", line) for line in plan if line.strip()]
    rising = names[::-1]
    stop = next(i for i, name in enumerate(rising) if name.startswith("Exchange"))
    return [name.split("(")[0].split(" ")[0] for name in rising[:stop]]


@pytest.mark.parametrize("stored_fact", [False, True])
def test_dates_need_no_sort_of_all_arrivals(spark, folder, stored_fact):
    adaptive = "spark.sql.adaptive.enabled"
    raw = arrivals(spark, {}, {"arrdate": None}, {"i94yr": None, "arrdate": 20455.0})
    raw.write.parquet(folder + "/arrivals")
    clean = clean_arrivals(spark.read.parquet(folder + "/arrivals"), dedupe=False)
    fact_arrivals(clean, ports(spark)).write.parquet(folder + "/fact")
    source = spark.read.parquet(folder + "/fact") if stored_fact else clean
    try:
        spark.conf.set(adaptive, "false")
        below = before_the_first_exchange(dims.dim_dates(source))
    finally:
        spark.conf.unset(adaptive)
    assert "HashAggregate" in below
    assert not {"SortAggregate", "Sort"} & set(below)
    assert rows(dims.dim_dates(source)) == rows(dims.dim_dates(clean))


def test_star_queries_pass_over_the_arrivals_once(spark):
    """The date table of a weekday summary comes from the same fact, whose exchange is reused."""
    import __spark_entry__ as contract

    adaptive = "spark.sql.adaptive.enabled"
    try:
        spark.conf.set(adaptive, "false")
        df = contract.queries()["stats_weekday"](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(adaptive)
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet", plan)) <= 4


def test_weekday_year_is_the_date_tables(spark):
    dates = spark.createDataFrame(
        [("2016-01-01", 2015, 1, 1, "Fri")],
        "arrival_date string, arrival_date_year int, arrival_date_month int, "
        "arrival_date_day int, weekday string",
    )
    f = fact(spark, {}, {"arrival_date": "2016-01-02"})
    assert set(rows(stats.stats_weekday(f, dates))) == {(2015, "Fri", 1), (None, None, 1)}
    assert rows(stats.stats_weekday(f, dates, years=[2015])) == [(2015, "Fri", 1)]


def test_unknown_visas_form_one_group_per_year(spark):
    visas = spark.createDataFrame([("B1", "Business")], "Visa_Type string, Visa_Purpose string")
    f = fact(spark, {}, {"visatype": "Q"}, {"visatype": "R", "count": 4})
    assert rows(stats.stats_visa(f, visas)) == [(2016, None, None, 5), (2016, "B1", "Business", 1)]


def test_codes_sharing_a_name_are_one_country(spark):
    names = spark.createDataFrame(
        [(583, "UNITED STATES"), (407, "UNITED STATES")], "Country_code int, Country string"
    )
    f = fact(spark, {"country_of_residence_cd": 583}, {"country_of_residence_cd": 407})
    assert rows(stats.stats_country(f, names)) == [(2016, "UNITED STATES", 2)]


def test_ports_of_a_city_are_one_city(spark):
    f = fact(
        spark,
        {"count": 5},
        {"port_of_entry": "LGA"},
        {"port_of_entry": "X1", "City": None, "State": None},
        {"port_of_entry": "X2", "City": None, "State": None},
    )
    assert rows(stats.stats_city(f)) == [(2016, "NEW YORK", "NY", 6), (2016, None, None, 2)]


def test_years_prune_the_fact(spark, folder):
    fact(spark, {}, {"arrival_date_year": 2017}).write.partitionBy(
        "arrival_date_year", "arrival_date_month"
    ).parquet(folder + "/fact")
    stored = spark.read.parquet(folder + "/fact")
    only = stats.stats_city(stored, years=[2017])
    assert rows(only) == [(2017, "NEW YORK", "NY", 1)]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*arrival_date_year#\d+ = 2017", plan)


def test_dim_ports_cleans_and_keeps_pair_rule(spark):
    raw = ports(spark, (".GA", "A    B", "N.Y. "), ("GA", "Z", "Z"), ("CP ", " A  B ", None))
    assert set(rows(dims.dim_ports(raw))) == {("GA", "A  B", "NY"), ("CP", "A B", None)}


def test_dim_visas(spark):
    raw = spark.createDataFrame(
        [("B-1", "Trip x"), ("B1", "Trap"), ("F1", None)], "`Visa Type` string, Purpose string"
    )
    assert set(rows(dims.dim_visas(raw))) == {("B1", "Trap"), ("F1", None)}


def test_dim_countries_bad_code_is_null(spark):
    raw = spark.createDataFrame(
        [("582", "MEXICO"), ("582", "MEXICO"), ("x", "NOWHERE")],
        "Country_code string, Country string",
    )
    assert set(rows(dims.dim_countries(raw))) == {(582, "MEXICO"), (None, "NOWHERE")}


def test_lookup_rows_are_counted_before_they_are_cleaned(spark):
    raw = spark.createDataFrame(
        [("JFK", "New (York)", "NY")] * 3 + [("LGA", "Queens", "NY")],
        "Code string, City string, State string",
    )
    visas = raw.selectExpr("Code AS `Visa Type`", "City AS Purpose")
    countries = raw.selectExpr("Code AS Country_code", "City AS Country")
    for dim in (dims.dim_ports(raw), dims.dim_visas(visas), dims.dim_countries(countries)):
        plan = dim._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate [") == 2
        assert dims.TIMES not in dim.columns
    assert dims.dim_ports(raw).count() == dims.dim_visas(visas).count() == 2


def test_enrich_refuses_repeated_keys_when_asked(spark):
    twice = ports(spark, ("JFK", "A", "A"), ("JFK", "B", "B"))
    left = spark.createDataFrame([("JFK",)], "port_of_entry string")
    with pytest.raises(NonUniqueKeyError):
        enrich(left, twice, "port_of_entry", "Code", ["City"], check_unique=True)
    with pytest.raises(ValueError, match="already present"):
        enrich(twice, ports(spark), "Code", "Code", ["City"])


def test_join_beyond_the_broadcast_limit(spark):
    """The same rows come out when the dimension is too large to broadcast and a key is hot."""
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id")
    right = spark.range(1000).selectExpr("id AS k", "concat('d', id) AS label")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = sorted(rows(enrich(left, right, "k", "k", ["label"])), key=str)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = enrich(left, right, "k", "k", ["label"])
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(joined), key=str) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_city_inflow_counts_each_arrival_once(spark):
    columns = (
        "City string, State string, State_Code string, Median_Age double, Male_Population int, "
        "Female_Population int, Total_Population int, Number_of_Veterans int, "
        "Average_Household_Size double"
    )
    cities = spark.createDataFrame(
        [
            ("New York", "New York", "NY", 36.0, 1, 2, 3, 4, 2.5),
            ("NEW YORK", "N York", "NY", 37.0, 1, 2, 3, 4, 2.5),
            (None, "None", "NY", 1.0, 1, 1, 1, 1, 1.0),
        ],
        columns,
    )
    f = fact(spark, {}, {"City": None, "State": None}, {"City": "ALBANY"})
    inflow = answers.city_inflow_demographics(f, cities)
    result = rows(inflow.select("City", "sum_count", "Median_Age"))
    assert sorted(result, key=str) == sorted(
        [("NEW YORK", 1, 36.0), (None, 1, None), ("ALBANY", 1, None)], key=str
    )


def test_answers(spark):
    f = fact(
        spark,
        {"count": 3},
        {"arrival_date": "2016-02-01", "arrival_date_month": 2, "port_of_entry": "LGA"},
        {"arrival_date": "2016-02-02", "arrival_date_month": 2, "count": 9},
    )
    assert rows(answers.top_ports(f, k=1)) == [("JFK", "NEW YORK", "NY", 12)]
    assert rows(answers.monthly_inflow(f)) == [(2016, 1, 3), (2016, 2, 10)]
    assert rows(answers.busiest_days(f, k=2)) == [("2016-02-02", 9), ("2016-01-01", 3)]
    trend = answers.weekday_trend(f, dims.dim_dates(f))
    assert rows(trend) == [(2016, 1, "Mon", 1), (2016, 2, "Tue", 9), (2016, 5, "Fri", 3)]


def test_decode_with_default(spark):
    df = spark.createDataFrame([("AL",), ("ZZ",), (None,)], "code string")
    labelled = decode(df, state_labels(spark), "code", "state", default="All Other Codes")
    assert set(rows(labelled)) == {
        ("AL", "ALABAMA"),
        ("ZZ", "All Other Codes"),
        (None, "All Other Codes"),
    }
    assert state_labels(spark).count() == 55


def test_mode_filter_reaches_the_scan(spark, folder):
    arrivals(spark, {}, {"i94mode": 2.0}).write.parquet(folder + "/raw")
    clean = clean_arrivals(spark.read.parquet(folder + "/raw"))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(i94mode,1.0)" in plan
    assert clean.count() == 1

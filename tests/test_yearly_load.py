"""The yearly load from files to summaries, loaded again and with bad inputs."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, duckdb_result, spark_result
from landfall.operators import DEFAULT_RULES, DataQualityError, TableRule
from landfall.plans import stats
from landfall.plans.fact import clean_arrivals
from landfall.plans.yearly_load import (
    Inputs,
    Lake,
    current,
    load_summaries,
    load_year,
    read_lake,
    read_summaries,
)
from landfall.schemas import LAKE_TABLES, RAW_ARRIVALS
from landfall.sources import (
    month_paths,
    overwrite,
    read_arrivals,
    read_csv,
    read_table,
    sample_tables,
    scratch_folder,
    write_csv,
    write_partitioned,
)
from landfall.sources.files import MONTH_FILE, MONTHS

ANY = [TableRule(rule.table) for rule in DEFAULT_RULES]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(text)


def land(spark, folder, year, rows, file_format="parquet"):
    """Twelve month files; ``rows`` maps a month number to its arrivals."""
    for number, path in enumerate(month_paths(folder + "/arrivals", year), start=1):
        df = spark.createDataFrame(rows.get(number, []), RAW_ARRIVALS).coalesce(1)
        if file_format == "csv":
            write_csv(df, path)
        else:
            overwrite(df, path)


def inputs(folder, **options):
    write(
        folder + "/ports.csv",
        "Code,City,State,Extra\n'JFK',NEW  YORK.,NY,1\nLGA,NEW YORK,NY,2\n",
    )
    write(
        folder + "/visas.csv",
        "Visa Type,Purpose\r\nB-1,Business\u00a0trip\r\nB-1,Business\u00a0trip\r\n",
    )
    write(
        folder + "/countries.csv",
        'Country_code,Country\r\n582,"MEXICO, all"\r\n209,JAPAN\r\n209,JAPAN\r\n',
    )
    write(
        folder + "/demographics.csv",
        "City;State;Median Age;Male Population;Female Population;Total Population;"
        "Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count\n"
        "New York;New York;36.0;4;5;9;1;3;2.7;NY;White;5\n"
        "New York;New York;36.0;4;5;9;1;3;2.7;NY;Asian;4\n",
    )
    return Inputs(
        arrivals=folder + "/arrivals",
        ports=folder + "/ports.csv",
        visas=folder + "/visas.csv",
        countries=folder + "/countries.csv",
        demographics=folder + "/demographics.csv",
        **options,
    )


def arrival(port="JFK", day=20454.0, year=2016.0, month=1.0, age=30.0, country=209.0):
    return (1.0, country, port, day, year, month, age, "B1")


FIRST = {
    1: [arrival(), arrival(), arrival(port="LGA"), arrival(country=1.0, age=0.0)],
    2: [arrival(day=20485.0, month=2.0), arrival(day=20454.0, month=2.0)],
}


def snapshot(spark, lake):
    tables = {**read_lake(spark, lake), **read_summaries(spark, lake)}
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in tables.items()}


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_load_and_load_again(spark, folder, file_format):
    land(spark, folder, 2016, FIRST, file_format)
    lake = Lake(folder + "/lake", folder + "/summaries")
    source = inputs(folder, file_format=file_format)
    report = load_year(spark, "2016", source, lake)
    assert all(row.passed for row in report)
    first = snapshot(spark, lake)
    assert first["US_Visas"] == [("B1", "Businesstrip")]
    assert first["country_codes"] == [(209, "JAPAN"), (582, "MEXICO, all")]
    assert first["cities_demographics"] == [
        ("New York", "New York", "NY", 36.0, 4, 5, 9, 1, 2.7)
    ]
    assert first["arrival_dates"] == [
        ("2016-01-01", 2016, 1, 1, "Fri"),
        ("2016-02-01", 2016, 2, 1, "Mon"),
    ]
    assert len(first["immigration_fact"]) == 5
    assert first["weekday"] == [(2016, "Fri", 4), (2016, "Mon", 1)]
    assert first["visa"] == [(2016, "B1", "Businesstrip", 5)]
    assert first["country"] == [(2016, "JAPAN", 4), (2016, None, 1)]
    assert first["city"] == [(2016, "NEW YORK", "NY", 5)]
    if file_format == "csv":
        return
    load_year(spark, 2016, source, lake)
    assert snapshot(spark, lake) == first


def test_a_stray_year_keeps_other_loads_whole(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    source = inputs(folder)
    land(spark, folder, 2015, {12: [arrival(day=20453.0, year=2015.0, month=12.0)]})
    stray = arrival(day=20453.0, year=2015.0, month=12.0, age=40.0)
    land(spark, folder, 2016, {1: [arrival(), stray]})
    load_year(spark, 2015, source, lake)
    load_year(spark, 2016, source, lake)
    both = snapshot(spark, lake)
    assert both["city"] == [(2015, "NEW YORK", "NY", 2), (2016, "NEW YORK", "NY", 1)]
    load_year(spark, 2015, source, lake)
    assert snapshot(spark, lake) == both
    # Only the summaries of one year are rewritten; the rest stays.
    load_summaries(spark, lake, years=[2016])
    assert snapshot(spark, lake) == both
    # The stray record is gone from the 2016 files: 2015 loses it although only 2016 is loaded.
    land(spark, folder, 2016, {1: [arrival()]})
    load_year(spark, 2016, source, lake)
    assert snapshot(spark, lake)["city"] == [
        (2015, "NEW YORK", "NY", 1), (2016, "NEW YORK", "NY", 1),
    ]


NO_KEYS = [TableRule(rule.table) for rule in DEFAULT_RULES]


def test_null_and_emptied_years_are_refreshed(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    source = inputs(folder)
    undated = arrival(day=None, year=None, month=None)
    land(spark, folder, 2016, {1: [arrival(), undated], 2: [arrival(day=19000.0, year=2012.0)]})
    load_year(spark, 2016, source, lake, NO_KEYS)
    first = snapshot(spark, lake)
    assert {row[0] for row in first["city"]} == {None, 2012, 2016}
    assert {row[0] for row in first["weekday"]} == {None, 2012, 2016}
    land(spark, folder, 2016, {1: [arrival()]})
    load_year(spark, 2016, source, lake, NO_KEYS)
    for name, rows in snapshot(spark, lake).items():
        if name in ("city", "visa", "country", "weekday"):
            assert {row[0] for row in rows} == {2016}, name


def test_a_failed_load_leaves_no_trace(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    source = inputs(folder)
    land(spark, folder, 2016, {1: [arrival()], 2: [arrival(day=19000.0, year=2012.0)]})
    load_year(spark, 2016, source, lake)
    before = snapshot(spark, lake)
    land(spark, folder, 2016, {1: [arrival(day=None)]})
    with pytest.raises(DataQualityError):
        load_year(spark, 2016, source, lake)
    assert snapshot(spark, lake) == before
    land(spark, folder, 2016, {1: [arrival()]})
    load_year(spark, 2016, source, lake)
    assert snapshot(spark, lake)["city"] == [(2016, "NEW YORK", "NY", 1)]


def test_equal_rows_of_two_month_files_are_two_arrivals(spark, folder):
    land(spark, folder, 2016, {1: [arrival(), arrival()], 2: [arrival()]})
    raw = read_arrivals(spark, folder + "/arrivals", 2016)
    assert sorted(r["file_month"] for r in raw.collect()) == [1, 1, 2]
    assert clean_arrivals(raw).count() == 2
    assert clean_arrivals(raw, per_file=False).count() == 1
    assert clean_arrivals(raw, dedupe=False).count() == 3
    lake = Lake(folder + "/lake", folder + "/summaries")
    load_year(spark, 2016, inputs(folder), lake)
    assert [r["count"] for r in read_lake(spark, lake)["immigration_fact"].collect()] == [2]


def test_figures_that_are_no_numbers_stop_the_load(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    land(spark, folder, 2016, {1: [arrival()]})
    source = inputs(folder)
    with open(source.demographics, encoding="utf-8") as file:
        text = file.read()
    write(source.demographics, text.replace("36.0;4;5;9;1", "36.0; 4.0;1,200;nine;1"))
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, source, lake)
    assert [(f.check_name, f.column_name, f.bad_rows) for f in error.value.failures] == [
        ("bad_number", "Total Population", 2)
    ]
    load_year(spark, 2016, source, lake, check_numbers=False)
    city = read_lake(spark, lake)["cities_demographics"].first()
    assert (city["Male_Population"], city["Female_Population"], city["Total_Population"]) == (
        4, 1200, None,
    )


def test_a_null_key_stops_before_summaries(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    land(spark, folder, 2016, {1: [arrival(day=None)]})
    source = inputs(folder)
    write(source.countries, "Country_code,Country\nx,NOWHERE\n")
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, source, lake)
    assert {f.table_name for f in error.value.failures} == {
        "country_codes", "arrival_dates", "countries",
    }
    assert not os.path.exists(folder + "/summaries")


def test_an_empty_year_fails_the_gate(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    land(spark, folder, 2016, {})
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, inputs(folder), lake, fail_fast=True)
    assert error.value.failures[0].check_name == "not_empty"


def test_load_of_the_sample_tables_matches_sql(spark, folder):
    """Landing files to stored summaries, against the same star schema in SQL."""
    data = "/root/testdata/sf0.001"
    landed = sample_tables.raw_arrivals(spark, data).withColumn(
        "file",
        F.expr("lower(date_format(make_date(2016, int(i94mon), 1), \"'i94_'MMM'16_sub'\"))"),
    )
    write_partitioned(landed, folder + "/arrivals", ["file"])
    write_csv(sample_tables.raw_ports(spark, data), folder + "/ports")
    write_csv(sample_tables.raw_visas(spark, data), folder + "/visas")
    write_csv(sample_tables.raw_countries(spark, data), folder + "/countries")
    write_csv(sample_tables.raw_demographics(spark, data), folder + "/cities", sep=";")
    source = Inputs(
        *[f"{folder}/{name}" for name in ("arrivals", "ports", "visas", "countries", "cities")],
        month_file="file=" + MONTH_FILE,
    )
    lake = Lake(folder + "/lake", folder + "/summaries")
    rules = [TableRule(rule.table) for rule in DEFAULT_RULES]
    load_year(spark, 2016, source, lake, rules, check_numbers=False)
    stored = {**read_lake(spark, lake), **read_summaries(spark, lake)}
    sql = contract.oracle_sql()
    pairs = {
        "US_Visas": "dim_visas",
        "country_codes": "dim_countries",
        "cities_demographics": "dim_cities",
        "arrival_dates": "dim_dates",
        "immigration_fact": "fact_arrivals",
        "weekday": "stats_weekday",
        "visa": "stats_visa",
        "country": "stats_country",
        "city": "stats_city",
    }
    con = connect(data)
    for table, query in pairs.items():
        assert spark_result(stored[table]) == duckdb_result(con, sql[query]), table


def test_month_paths():
    paths = month_paths("root/", "2016", suffix=".parquet")
    assert paths[0] == "root/i94_jan16_sub.parquet" and len(paths) == len(MONTHS) == 12


def test_months_are_one_scan(spark, folder):
    land(spark, folder, 2016, FIRST)
    df = read_arrivals(spark, folder + "/arrivals", 2016)
    assert df.count() == 6
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_csv_columns_are_found_by_name(spark, folder):
    write(
        folder + "/in.csv",
        "visatype,other,i94mode,i94res,i94port,arrdate,i94yr,i94mon,i94bir\n"
        'B1,x,1.0,209,"A, B",20454,2016,1,\n',
    )
    assert [tuple(r) for r in read_csv(spark, folder + "/in.csv", RAW_ARRIVALS).collect()] == [
        (1.0, 209.0, "A, B", 20454.0, 2016.0, 1.0, None, "B1")
    ]
    write(folder + "/bad.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="i94mode"):
        read_csv(spark, folder + "/bad.csv", RAW_ARRIVALS)
    assert dict(read_csv(spark, folder + "/bad.csv").dtypes) == {"a": "int", "b": "int"}


def test_dynamic_overwrite_touches_only_its_partitions(spark, folder):
    path = folder + "/t"

    def save(rows, **options):
        write_partitioned(spark.createDataFrame(rows, "k int, v string"), path, ["k"], **options)

    save([(1, "a"), (2, "b"), (None, "n")])
    save([(2, "c")])
    stored = sorted(map(tuple, read_table(spark, path).collect()), key=str)
    assert stored == [("a", 1), ("c", 2), ("n", None)]
    save([(2, "d")], mode="append")
    assert read_table(spark, path).count() == 4
    save([(9, "z")], mode="overwrite")
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("z", 9)]
    with pytest.raises(ValueError):
        save([(9, "z")], mode="x")


def test_a_partitioned_write_needs_no_sort(spark):
    fact = spark.createDataFrame([], LAKE_TABLES["immigration_fact"])
    written = stats.stats_city(fact).hint("rebalance", "arrival_date_year")
    assert "Sort" not in written._jdf.queryExecution().optimizedPlan().toString()


def test_one_large_partition_is_written_by_several_tasks(spark, folder):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "64KB")
        df = spark.range(60000, numPartitions=8).selectExpr(
            "if(id % 3 = 0, id % 4, 99) AS k", "uuid() AS v"
        )
        write_partitioned(df, folder + "/t", ["k"])
    finally:
        spark.conf.set(size, before)
    files = [f for f in os.listdir(folder + "/t/k=99") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_table(spark, folder + "/t").count() == 60000


def test_scratch_folder_is_fresh_and_follows_the_setting(spark):
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or one.startswith(shared)


def test_a_reload_keeps_the_dimensions_of_unchanged_files(spark, folder):
    lake = Lake(folder + "/lake", folder + "/summaries")
    source = inputs(folder)
    land(spark, folder, 2016, FIRST)
    report = load_year(spark, 2016, source, lake)
    names = ("US_Visas", "country_codes", "cities_demographics")
    first = {name: current(spark, lake).parts(name) for name in names}
    land(spark, folder, 2016, {2: [arrival(day=20486.0, month=2.0)]})
    assert load_year(spark, 2016, source, lake) == report
    assert {name: current(spark, lake).parts(name) for name in names} == first
    write(folder + "/countries.csv", "Country_code,Country\n1,ALBANIA\nnone,NOWHERE\n")
    again = load_year(spark, 2016, source, lake, ANY, check_numbers=False)
    assert len(again) == len(ANY)
    after = {name: current(spark, lake).parts(name) for name in names}
    assert [name for name in names if after[name] != first[name]] == ["country_codes"]
    assert snapshot(spark, lake)["country_codes"] == [(1, "ALBANIA"), (None, "NOWHERE")]
    # text that is no number is remembered with the file that is not read again
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, source, lake, ANY)
    assert [(r.table_name, r.bad_rows) for r in error.value.failures] == [("countries", 1)]


def test_a_corrected_month_comes_from_the_landed_files(spark, monkeypatch):
    made = []
    raw_arrivals = contract.sample.raw_arrivals
    monkeypatch.setattr(
        contract.sample, "raw_arrivals", lambda *a: made.append(a) or raw_arrivals(*a)
    )
    source, _ = contract._corrected(spark, "/root/testdata/sf0.001")
    assert len(made) == 1
    february = contract.io.month_paths(source.arrivals, 2016, name=contract.LANDED_FILE)[1]
    expected = raw_arrivals(spark, "/root/testdata/sf0.001").where(
        "i94mon = 2 AND i94bir IS NOT NULL"
    )
    found = spark.read.parquet(february)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).count() == 0

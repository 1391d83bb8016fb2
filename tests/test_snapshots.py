"""Loads as snapshots: nothing shows before the end, and only what changed is read."""

import random

import pytest
from pyspark.sql import functions as F

from compare import spark_result
from landfall.operators import DataQualityError, TableRule
from landfall.operators.views import ROWS, TOTAL, AdditiveView
from landfall.plans import dims, stats, yearly_load
from landfall.plans.yearly_load import Lake, current, expire, load_year, read_lake, read_summaries
from landfall.schemas import FACT
from landfall.sources import snapshots, write_csv
from landfall.sources.snapshots import ConcurrentChangeError, Snapshot
from test_yearly_load import NO_KEYS, arrival, inputs, land, snapshot, write

STEPS = [
    "stage_dimensions", "count_files", "stage_months", "stage_fact", "stage_views",
    "stage_dates", "audit", "stage_summaries", "publish",
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A lake with two years, and inputs that would change everything."""
    folder = str(tmp_path_factory.mktemp("lake"))
    lake, source = Lake(folder + "/lake", folder + "/summaries"), inputs(folder)
    stray = arrival(day=20453.0, year=2015.0, month=12.0, age=40.0)
    land(spark, folder, 2015, {12: [arrival(day=20453.0, year=2015.0, month=12.0)]})
    land(spark, folder, 2016, {1: [arrival(), stray], 2: [arrival(day=20485.0, month=2.0)]})
    load_year(spark, 2015, source, lake)
    load_year(spark, 2016, source, lake)
    land(spark, folder, 2016, {1: [arrival(age=50.0)], 3: [arrival(day=20520.0, month=3.0)]})
    write(source.visas, "Visa Type,Purpose\nB-1,Other\n")
    return lake, source


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_ends_at_any_step_changes_nothing(spark, loaded, monkeypatch, step):
    lake, source = loaded
    before, number = snapshot(spark, lake), current(spark, lake).number
    whole = getattr(yearly_load, step)

    def broken(*args, **kwargs):
        if step != "publish":
            whole(*args, **kwargs)  # all that the step writes is there
        raise RuntimeError(step)

    monkeypatch.setattr(yearly_load, step, broken)
    with pytest.raises(RuntimeError, match=step):
        load_year(spark, 2016, source, lake)
    assert current(spark, lake).number == number
    assert snapshot(spark, lake) == before


def test_a_failed_check_leaves_every_live_table(spark, loaded):
    lake, source = loaded
    before = snapshot(spark, lake)
    rules = [TableRule("country_codes", ("Country",)), TableRule("US_Visas", ("Visa_Purpose",), True)]
    text = open(source.countries, encoding="utf-8").read()
    try:
        write(source.countries, text + "77,\n")
        with pytest.raises(DataQualityError) as error:
            load_year(spark, 2016, source, lake, rules)
    finally:
        write(source.countries, text)
    assert [f.column_name for f in error.value.failures] == ["Country"]
    assert snapshot(spark, lake) == before


def test_of_two_loads_at_a_time_the_second_to_publish_changes_nothing(spark, folder):
    root = folder + "/lake"
    first, second = snapshots.current(spark, root).next(), snapshots.current(spark, root).next()
    first.tables["t"], second.tables["t"] = {"all": "t/one"}, {"all": "t/two"}
    snapshots.publish(spark, root, first)
    with pytest.raises(ConcurrentChangeError):
        snapshots.publish(spark, root, second)
    assert snapshots.current(spark, root) == Snapshot(1, {"t": {"all": "t/one"}}, {})
    assert snapshots.current(spark, root + "/other") == Snapshot()


@pytest.fixture
def seen(monkeypatch):
    """The months that are read from landing files, and the fact folders that are read."""
    months, folders = [], []
    scan, parts = yearly_load.read_arrivals, snapshots.read_folders

    def scanned(spark, root, year, names, *rest):
        months.extend(names)
        return scan(spark, root, year, names, *rest)

    def read(spark, root, wanted, schema):
        wanted = list(wanted)
        if schema == FACT:
            folders.extend(wanted)
        return parts(spark, root, wanted, schema)

    monkeypatch.setattr(yearly_load, "read_arrivals", scanned)
    monkeypatch.setattr(snapshots, "read_folders", read)
    return months, folders


def test_only_changed_month_files_and_touched_parts_are_read(spark, folder, seen):
    months, folders = seen
    lake, source = Lake(folder + "/lake", folder + "/summaries"), inputs(folder)
    for year, day in ((2015, 20089.0), (2016, 20454.0)):
        rows = {
            m: [arrival(day=day + 31.0 * (m - 1), year=float(year), month=float(m))]
            for m in (1, 2, 3)
        }
        land(spark, folder, year, rows)
        load_year(spark, year, source, lake)
    assert sorted(months) == sorted([*yearly_load.MONTHS] * 2)
    first = snapshot(spark, lake)
    months.clear(), folders.clear()

    # unchanged input: nothing is read
    load_year(spark, 2016, source, lake)
    assert months == [] and folders == []
    assert snapshot(spark, lake) == first
    folders.clear()

    # one changed month: its file, and its old and new part of the fact
    path = yearly_load.month_paths(source.arrivals, 2016)[1]
    other = spark.createDataFrame(
        [arrival(day=20485.0, month=2.0), arrival(day=20486.0, month=2.0, age=9.0)],
        yearly_load.RAW_ARRIVALS,
    )
    before = current(spark, lake).parts(yearly_load.FACT_TABLE)
    yearly_load.overwrite(other, path)
    load_year(spark, 2016, source, lake)
    after = current(spark, lake).parts(yearly_load.FACT_TABLE)
    assert months == ["feb"]
    changed = {before["2016/2016,2"], after["2016/2016,2"]}
    assert set(folders) == changed
    assert {k: v for k, v in before.items() if k != "2016/2016,2"} == {
        k: v for k, v in after.items() if k != "2016/2016,2"
    }
    assert snapshot(spark, lake)["city"] == [
        (2015, "NEW YORK", "NY", 3), (2016, "NEW YORK", "NY", 4),
    ]

    # another city of a port: all files of the year again
    months.clear()
    write(source.ports, "Code,City,State\nJFK,QUEENS,NY\n")
    load_year(spark, 2016, source, lake)
    assert len(months) == 12
    assert snapshot(spark, lake)["city"] == [
        (2015, "NEW YORK", "NY", 3), (2016, "QUEENS", "NY", 4),
    ]

    # a month that is not asked for any more
    months.clear()
    fewer = yearly_load.Inputs(**{**vars(source), "months": ("jan", "mar")})
    load_year(spark, 2016, fewer, lake)
    assert months == []
    assert [r for r in snapshot(spark, lake)["city"] if r[0] == 2016] == [(2016, "QUEENS", "NY", 2)]

    # what no snapshot names any more goes; what it names stays
    whole = snapshot(spark, lake)
    assert expire(spark, lake, keep=1) > 0
    assert snapshot(spark, lake) == whole
    assert expire(spark, lake, keep=1) == 0
    load_year(spark, 2016, fewer, lake)
    assert snapshot(spark, lake) == whole


def rebuilt(spark, lake):
    """Dates and summaries from a scan of the whole fact."""
    tables = read_lake(spark, lake)
    fact = tables["immigration_fact"]
    dates = dims.dim_dates(fact)
    return {
        "arrival_dates": dates,
        "weekday": stats.stats_weekday(fact, dates),
        "visa": stats.stats_visa(fact, tables["US_Visas"]),
        "country": stats.stats_country(fact, tables["country_codes"]),
        "city": stats.stats_city(fact),
    }


def test_views_by_difference_equal_a_rebuild_after_any_order(spark, folder):
    rng = random.Random(5)
    lake, source = Lake(folder + "/lake", folder + "/summaries"), inputs(folder)

    def rows(year):
        found = {}
        for month in rng.sample(range(1, 13), 3):
            found[month] = [
                arrival(
                    port=rng.choice(["JFK", "LGA", "XXX"]),
                    day=rng.choice([None, 20454.0, 20485.0, 20089.0]),
                    year=rng.choice([float(year), float(year), 2014.0, None]),
                    month=float(rng.choice([month, 1])),
                    country=rng.choice([209.0, 582.0, 1.0]),
                )
                for _ in range(rng.randint(0, 6))
            ]
        return found

    for year in (2016, 2015, 2016, 2015):
        land(spark, folder, year, rows(year))
        load_year(spark, year, source, lake, NO_KEYS, per_file=rng.random() < 0.7)
        stored = {**read_lake(spark, lake), **read_summaries(spark, lake)}
        for name, table in rebuilt(spark, lake).items():
            assert spark_result(stored[name]) == spark_result(table), (year, name)
        fact = stored["immigration_fact"]
        keys = [c for c in FACT.names if c != "count"]
        for name, view in yearly_load.VIEWS.items():
            kept = yearly_load.read(spark, lake, current(spark, lake), name)
            assert spark_result(kept) == spark_result(view.of(fact)), (year, name)
    assert fact.groupBy(*keys, F.lit(1)).count().count() > 0


def test_a_view_takes_back_what_it_was_given(spark):
    view = AdditiveView(("k",), "n")

    def table(rows):
        return spark.createDataFrame(rows, "k string, n long")

    start = view.of(table([("a", 1), ("a", 2), (None, 5), ("b", 7)]))
    after = view.changed(start, table([("a", 2), (None, 5)]), table([("c", 0), ("b", 1)]))
    assert sorted(map(tuple, after.select("k", ROWS, TOTAL).collect())) == [
        ("a", 1, 1), ("b", 2, 8), ("c", 1, 0),
    ]


def test_bad_numbers_of_csv_months_are_counted_by_the_load_itself(spark, folder, monkeypatch):
    lake, source = Lake(folder + "/lake", folder + "/summaries"), inputs(folder, file_format="csv")
    land(spark, folder, 2016, {1: [arrival()], 2: [arrival(day=20485.0, month=2.0)]}, "csv")
    january = spark.createDataFrame(
        [("1.0", "209", "JFK", "20454", "2016", "1", "thirty", "B1"),
         ("1.0", "2o9", "JFK", "20454", "2016", "1", "30", "B1")],
        ", ".join(f"{name} string" for name in yearly_load.RAW_ARRIVALS.names),
    )
    write_csv(january.coalesce(1), yearly_load.month_paths(source.arrivals, 2016)[0])
    scans = []
    scan = yearly_load.read_arrivals_text
    monkeypatch.setattr(
        yearly_load, "read_arrivals_text", lambda *args: scans.append(args[3]) or scan(*args)
    )
    expected = {("i94bir", 1), ("i94res", 1)}
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, source, lake)
    assert {(f.column_name, f.bad_rows) for f in error.value.failures} == expected
    assert len(scans) == 1
    report = load_year(spark, 2016, source, lake, check_numbers=False)
    assert all(row.check_name != "bad_number" for row in report)
    scans.clear()
    # the counts of unchanged months are remembered
    with pytest.raises(DataQualityError) as error:
        load_year(spark, 2016, source, lake)
    assert {(f.column_name, f.bad_rows) for f in error.value.failures} == expected
    assert scans == []

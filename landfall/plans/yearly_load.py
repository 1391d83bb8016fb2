"""Loading one year: everything is written beside the live tables, checked, and published at once.

A load stages new folders for the dimensions, the fact, the views and the summaries, checks the
staged tables and then publishes one snapshot that names them. Readers see the state before or
after, nothing between, and a failed load or check leaves no trace in what they see.

The fact is kept in parts, one per load year and month of record, each the counts of the month
files that hold such records. A load reads the month files that are new or changed, and of the
fact the parts that those files touch. Dates and summaries come from views: sums by a few keys,
from which the replaced parts are subtracted and to which the new ones are added.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from landfall.functions import bad_number, day_of_month, text_to_int, weekday_name
from landfall.operators.dedupe import first_per_key
from landfall.operators.quality import (
    BAD_NUMBER,
    DEFAULT_RULES,
    REPORT,
    TableRule,
    enforce,
)
from landfall.operators.views import ROWS, TOTAL, AdditiveView
from landfall.plans.dims import dim_cities, dim_countries, dim_ports, dim_visas
from landfall.plans.fact import clean_arrivals, fact_arrivals
from landfall.plans.stats import YEAR, stats_city, stats_country, stats_visa, stats_weekday
from landfall.schemas import (
    FACT,
    FILE_MONTH,
    LAKE_TABLES,
    RAW_ARRIVALS,
    RAW_COUNTRIES,
    RAW_DEMOGRAPHICS,
    RAW_PORTS,
    RAW_VISAS,
    SUMMARY_TABLES,
)
from landfall.sources import (
    bad_numbers,
    month_paths,
    overwrite,
    read_arrivals,
    read_arrivals_text,
    read_csv,
    read_csv_text,
    typed,
    write_partitioned,
)
from landfall.sources import snapshots
from landfall.sources.files import MONTH_FILE, MONTHS
from landfall.sources.snapshots import Snapshot

FACT_TABLE, DATE_TABLE = "immigration_fact", "arrival_dates"
MONTH = "arrival_date_month"
COUNT = "count"

#: Counted arrivals of single month files.
FILE_COUNTS = "month_file_counts"

#: Columns that parts are written by; the parts keep the year and month as columns too.
PART_YEAR, PART_MONTH = "part_year", "part_month"

#: The part of a table that has one, and the month file of loads that count over all files.
WHOLE, ALL_FILES = "all", 0

VIEWS = {
    "view_days": AdditiveView(("arrival_date", YEAR, MONTH)),
    "view_visas": AdditiveView((YEAR, "visatype")),
    "view_countries": AdditiveView((YEAR, "country_of_residence_cd")),
    "view_cities": AdditiveView((YEAR, "City", "State")),
}
VIEW_SCHEMAS = {name: view.schema(FACT) for name, view in VIEWS.items()}

FILE_FACT = StructType([StructField(FILE_MONTH, IntegerType()), *FACT])


@dataclass(frozen=True)
class Inputs:
    """Where the landing files are."""

    arrivals: str
    ports: str
    visas: str
    countries: str
    demographics: str
    file_format: str = "parquet"
    month_file: str = MONTH_FILE
    suffix: str = ""
    months: Sequence[str] = MONTHS


@dataclass(frozen=True)
class Lake:
    """Where the tables and the summaries are kept."""

    tables: str
    summaries: str

    def root(self, name: str) -> str:
        return (self.summaries if name in SUMMARY_TABLES else self.tables).rstrip("/")

    def places(self) -> dict[str, str]:
        names = [*LAKE_TABLES, *SUMMARY_TABLES, *VIEWS, FILE_COUNTS]
        return {name: f"{self.root(name)}/{name}" for name in names}


SCHEMAS = {**LAKE_TABLES, **SUMMARY_TABLES, **VIEW_SCHEMAS}


def current(spark: SparkSession, lake: Lake) -> Snapshot:
    """The published state of the lake."""
    return snapshots.current(spark, lake.root(FACT_TABLE))


def read(spark: SparkSession, lake: Lake, snapshot: Snapshot, name: str) -> DataFrame:
    """A table, view or summary of a snapshot."""
    folders = snapshot.parts(name).values()
    return snapshots.read_folders(spark, lake.root(name), folders, SCHEMAS[name])


def read_lake(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All tables of the lake by name, of one snapshot."""
    now = current(spark, lake)
    return {name: read(spark, lake, now, name) for name in LAKE_TABLES}


def read_summaries(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All summaries of the lake by name, of one snapshot."""
    now = current(spark, lake)
    return {name: read(spark, lake, now, name) for name in SUMMARY_TABLES}


def expire(spark: SparkSession, lake: Lake, keep: int = 2) -> int:
    """Remove older snapshots and the folders that only they, or failed loads, hold."""
    return snapshots.expire(spark, lake.root(FACT_TABLE), lake.places(), keep)


# Writing parts


def _staged(lake: Lake, staged: Snapshot, name: str, df: DataFrame) -> None:
    """Write ``df`` as the only part of a table of ``staged``."""
    folder = snapshots.new_folder(name)
    overwrite(df, f"{lake.root(name)}/{folder}")
    staged.tables[name] = {WHOLE: folder}


def _written_parts(
    spark: SparkSession, lake: Lake, name: str, df: DataFrame, by: dict[str, str]
) -> dict[tuple, str]:
    """Write ``df`` in folders by copies of columns (name of the copy to column): the values to
    the folder that holds them."""
    folder = snapshots.new_folder(name)
    copies = df.withColumns({copy: F.col(column) for copy, column in by.items()})
    write_partitioned(copies, f"{lake.root(name)}/{folder}", list(by), mode="overwrite")
    return snapshots.leaf_folders(spark, lake.root(name), folder, len(by))


# Numbers that are none, counted while the rows are written


class NumberCounts:
    """Counts of text that is no number, taken by the job that writes the rows."""

    def __init__(self, table: str, bad: dict[str, Column]):
        self.table, self.names = table, list(bad)
        self.columns = [F.count_if(c).alias(f"bad_{i}") for i, c in enumerate(bad.values())]
        self.seen = Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.seen, *self.columns)

    def counts(self) -> dict[str, int]:
        """By column; to be asked for after the rows were written."""
        found = self.seen.get
        return {name: found[f"bad_{i}"] for i, name in enumerate(self.names)}


def _number_rows(table: str, counts: dict[str, int]) -> list[tuple]:
    """Lines of the report, as ``bad_number_report`` gives them."""
    return [(table, BAD_NUMBER, name, n == 0, n) for name, n in counts.items()]


# The steps of a load


def stage_dimensions(
    spark: SparkSession, inputs: Inputs, lake: Lake, staged: Snapshot
) -> list[tuple]:
    """The three dimensions that come from lookup files; the report of their numbers.

    The snapshot's notes keep the state of each file and how much of its text is no number; a
    dimension whose file did not change since the published load stays as it is.
    """
    paths = {
        "US_Visas": inputs.visas,
        "country_codes": inputs.countries,
        "cities_demographics": inputs.demographics,
    }
    states = {name: [path, snapshots.file_states(spark, path)] for name, path in paths.items()}
    known = staged.notes.get("dimensions", {})
    kept = {
        name: known[name]
        for name, state in states.items()
        # a path of which no file is seen, as a pattern, tells nothing of changes
        if state[1] and known.get(name, {}).get("state") == state and staged.parts(name)
    }
    bad = {name: note["bad"] for name, note in kept.items()}
    if "US_Visas" not in kept:
        _staged(lake, staged, "US_Visas", dim_visas(read_csv(spark, inputs.visas, RAW_VISAS)))
        bad["US_Visas"] = {}
    if "country_codes" not in kept:
        countries = read_csv_text(spark, inputs.countries, RAW_COUNTRIES)
        code = bad_number("Country_code", text_to_int("Country_code"))
        of_countries = NumberCounts("countries", {"Country_code": code})
        _staged(lake, staged, "country_codes", dim_countries(of_countries.watch(countries)))
        bad["country_codes"] = of_countries.counts()
    if "cities_demographics" not in kept:
        cities = read_csv_text(spark, inputs.demographics, RAW_DEMOGRAPHICS, sep=";")
        of_cities = NumberCounts("demographics", bad_numbers(cities, RAW_DEMOGRAPHICS))
        rows = dim_cities(typed(of_cities.watch(cities), RAW_DEMOGRAPHICS))
        _staged(lake, staged, "cities_demographics", rows)
        bad["cities_demographics"] = of_cities.counts()
    staged.notes["dimensions"] = {
        name: {"state": state, "bad": bad[name]} for name, state in states.items()
    }
    return [
        *_number_rows("demographics", bad["cities_demographics"]),
        *_number_rows("countries", bad["country_codes"]),
    ]


def _paths(inputs: Inputs, year: int, months: Sequence[str]) -> list[str]:
    return month_paths(inputs.arrivals, year, months, inputs.month_file, inputs.suffix)


def month_states(
    spark: SparkSession, year: int, inputs: Inputs, per_file: bool
) -> dict[str, dict]:
    """For each unit of files that is counted by itself what its counts depend on: the files of
    a month, or of all months without ``per_file``, and the ports, each with length and time."""
    ports = snapshots.file_states(spark, inputs.ports)
    files = {
        month: snapshots.file_states(spark, path)
        for month, path in zip(inputs.months, _paths(inputs, year, inputs.months))
    }
    units = {month: {month: states} for month, states in files.items()} if per_file else {
        WHOLE: files
    }
    how = [inputs.file_format, inputs.arrivals, inputs.ports]
    return {unit: {"files": found, "ports": ports, "how": how} for unit, found in units.items()}


def count_files(
    spark: SparkSession,
    year: int,
    inputs: Inputs,
    lake: Lake,
    months: Sequence[str],
    per_file: bool,
) -> tuple[dict[tuple, str], dict[str, int]]:
    """Count the arrivals of the given month files in one scan: the folders of the counts by
    number of the file's month, year and month of record, and how much text is no number."""
    arguments = (
        spark, inputs.arrivals, year, months, inputs.file_format, inputs.month_file, inputs.suffix,
    )
    numbers = None
    if inputs.file_format == "csv":
        text = read_arrivals_text(*arguments)
        bad = bad_numbers(text, RAW_ARRIVALS)
        # each file's month counts for itself, as months are counted again one by one
        units = {
            f"{name} {month}": column & (F.col(FILE_MONTH) == MONTHS.index(month) + 1)
            for month in months
            for name, column in bad.items()
        }
        numbers = NumberCounts("arrivals", units)
        raw = typed(numbers.watch(text), RAW_ARRIVALS)
    else:
        raw = read_arrivals(*arguments)
    ports = dim_ports(read_csv(spark, inputs.ports, RAW_PORTS))
    clean = clean_arrivals(raw, per_file=per_file, keep_file=per_file)
    if not per_file:
        clean = clean.withColumn(FILE_MONTH, F.lit(ALL_FILES))
    counted = fact_arrivals(clean, ports, also=[FILE_MONTH])
    by = {f"part_{FILE_MONTH}": FILE_MONTH, PART_YEAR: YEAR, PART_MONTH: MONTH}
    folders = _written_parts(spark, lake, FILE_COUNTS, counted, by)
    return folders, numbers.counts() if numbers else {}


def stage_months(
    spark: SparkSession,
    year: int | str,
    inputs: Inputs,
    lake: Lake,
    staged: Snapshot,
    per_file: bool = True,
) -> tuple[set[str], list[tuple]]:
    """Count the month files that are new or changed since the published load of this year.

    The snapshot's notes keep, for each year and month file, its state and the folders of its
    counts. Returns the months of record whose part of the fact changes, and the report of the
    year's numbers. Files that are gone, or not asked for any more, no longer contribute.
    """
    year = int(year)
    known = staged.notes.setdefault("units", {}).get(str(year), {})
    states = month_states(spark, year, inputs, per_file)
    same = {unit for unit, state in states.items() if known.get(unit, {}).get("state") == state}
    units = {unit: known[unit] for unit in same}
    changed = [unit for unit in states if unit not in same]
    if changed:
        months = changed if per_file else list(inputs.months)
        folders, bad = count_files(spark, year, inputs, lake, months, per_file)
        for unit in changed:
            number = MONTHS.index(unit) + 1 if per_file else ALL_FILES
            parts = {
                f"{y},{m}": folder for (n, y, m), folder in folders.items() if int(n) == number
            }
            counts: dict[str, int] = {}
            for name, n in bad.items():
                column, _, month = name.rpartition(" ")
                if month in states[unit]["files"]:
                    counts[column] = counts.get(column, 0) + n
            units[unit] = {"state": states[unit], "parts": parts, "bad": counts}
    staged.notes["units"][str(year)] = units
    gone = [unit for name, unit in known.items() if units.get(name) is not unit]
    fresh = [units[unit] for unit in changed]
    touched = {part for unit in [*gone, *fresh] for part in unit["parts"]}
    total: dict[str, int] = {}
    for unit in units.values():
        for column, n in unit["bad"].items():
            total[column] = total.get(column, 0) + n
    return touched, _number_rows("arrivals", total)


def stage_fact(
    spark: SparkSession, year: int | str, lake: Lake, staged: Snapshot, touched: Iterable[str]
) -> tuple[list[str], list[str]]:
    """Replace the touched parts of what this year's files contribute to the fact; the folders
    that leave it and those that come.

    A part to which one file contributes is that file's counts as they are; the counts of several
    files are summed. Parts bear the load's year, so a record whose own year differs from its
    file's never displaces rows that came with another year's files.
    """
    parts = staged.tables.setdefault(FACT_TABLE, {})
    contributions: dict[str, list[str]] = {part: [] for part in touched}
    for unit in staged.notes["units"][str(int(year))].values():
        for part, folder in unit["parts"].items():
            if part in contributions:
                contributions[part].append(folder)
    several = [f for folders in contributions.values() if len(folders) > 1 for f in folders]
    merged = {}
    if several:
        rows = snapshots.read_folders(spark, lake.root(FILE_COUNTS), several, FACT)
        keys = [name for name in FACT.names if name != COUNT]
        sums = rows.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT)).select(*FACT.names)
        by = {PART_YEAR: YEAR, PART_MONTH: MONTH}
        merged = _written_parts(spark, lake, FACT_TABLE, sums, by)
        merged = {f"{y},{m}": folder for (y, m), folder in merged.items()}
    removed, added = [], []
    for part, folders in contributions.items():
        key = f"{int(year)}/{part}"
        if key in parts:
            removed.append(parts.pop(key))
        if folders:
            parts[key] = folders[0] if len(folders) == 1 else merged[part]
            added.append(parts[key])
    return removed, added


def stage_views(
    spark: SparkSession,
    lake: Lake,
    staged: Snapshot,
    removed: Sequence[str],
    added: Sequence[str],
) -> None:
    """Bring the views up to date, reading only the folders that leave or enter the fact."""
    root = lake.root(FACT_TABLE)
    old, new = (snapshots.read_folders(spark, root, f, FACT) for f in (removed, added))
    for name, view in VIEWS.items():
        _staged(lake, staged, name, view.changed(read(spark, lake, staged, name), old, new))


def dates_of(days: DataFrame) -> DataFrame:
    """The date table of the view by date, year and month: one row per date, as ``dim_dates``."""
    first = first_per_key(days.select("arrival_date", YEAR, MONTH), ["arrival_date"])
    return first.select(
        "arrival_date",
        YEAR,
        MONTH,
        day_of_month("arrival_date").alias("arrival_date_day"),
        weekday_name("arrival_date").alias("weekday"),
    )


def stage_dates(spark: SparkSession, lake: Lake, staged: Snapshot) -> None:
    """The date table, from the view: unique on the date however often a year is loaded, and
    without the dates of rows that left the fact."""
    _staged(lake, staged, DATE_TABLE, dates_of(read(spark, lake, staged, "view_days")))


def audit(
    spark: SparkSession,
    lake: Lake,
    staged: Snapshot,
    rules: Sequence[TableRule] = DEFAULT_RULES,
    fail_fast: bool = False,
    numbers: Sequence[tuple] = (),
) -> list[Row]:
    """Check the staged tables; raises ``DataQualityError`` if a check fails.

    A rule without keys asks only whether the fact has rows, which its view by day answers.
    """
    sources = {rule.table: rule.table for rule in rules}
    if not any(rule.keys for rule in rules if rule.table == FACT_TABLE):
        sources[FACT_TABLE] = "view_days"
    tables = {name: read(spark, lake, staged, source) for name, source in sources.items()}
    also = [spark.createDataFrame(list(numbers), REPORT)] if numbers else []
    return enforce(tables, rules, fail_fast, also)


def stage_summaries(
    spark: SparkSession,
    lake: Lake,
    staged: Snapshot,
    years: Iterable[int | None] | None = None,
    weekday_years: Iterable[int | None] | None = None,
) -> None:
    """The four summaries from the views and dimensions, one part per year.

    Without ``years`` they are rebuilt for all years, so that a changed label shows everywhere.
    With ``years`` exactly those are replaced, and a year without rows is removed. The weekday
    summary, whose year is the date table's, is replaced for ``weekday_years``.
    """
    years = None if years is None else list(years)
    weekday_years = years if weekday_years is None else list(weekday_years)

    def view(name: str) -> DataFrame:
        return read(spark, lake, staged, name).withColumnRenamed(TOTAL, COUNT).drop(ROWS)

    def table(name: str) -> DataFrame:
        return read(spark, lake, staged, name)

    summaries = {
        "weekday": stats_weekday(view("view_days"), table(DATE_TABLE), weekday_years),
        "visa": stats_visa(view("view_visas"), table("US_Visas"), years),
        "country": stats_country(view("view_countries"), table("country_codes"), years),
        "city": stats_city(view("view_cities"), years),
    }
    for name, summary in summaries.items():
        replaced = weekday_years if name == "weekday" else years
        parts = {} if replaced is None else staged.tables.get(name, {})
        written = _written_parts(spark, lake, name, summary, {PART_YEAR: YEAR})
        for year in replaced or ():
            parts.pop(str(year), None)
        staged.tables[name] = {**parts, **{str(y): folder for (y,), folder in written.items()}}


def publish(spark: SparkSession, lake: Lake, staged: Snapshot) -> None:
    """Make the staged state the current one, for all tables at once."""
    snapshots.publish(spark, lake.root(FACT_TABLE), staged)


def load_summaries(
    spark: SparkSession,
    lake: Lake,
    years: Iterable[int | None] | None = None,
    weekday_years: Iterable[int | None] | None = None,
) -> None:
    """Write the summaries again from the published views and publish them; see
    ``stage_summaries``."""
    staged = current(spark, lake).next()
    stage_summaries(spark, lake, staged, years, weekday_years)
    publish(spark, lake, staged)


def _weekday_years(
    spark: SparkSession, lake: Lake, touched: Iterable[str], states: Sequence[Snapshot]
) -> set[int | None]:
    """The years that the date tables of the states give the dates of the touched months of
    record, as their views by day tell them."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in (YEAR, MONTH)]
    in_touched = F.concat_ws(",", *parts).isin(list(touched))
    days = [read(spark, lake, state, "view_days").where(in_touched) for state in states]
    seen = reduce(DataFrame.union, [d.select("arrival_date") for d in days]).distinct()
    years = []
    for state in states:
        dates = read(spark, lake, state, DATE_TABLE).select("arrival_date", YEAR)
        years.append(seen.join(dates, "arrival_date", "left").select(YEAR))
    return {row[0] for row in reduce(DataFrame.union, years).distinct().collect()}


def load_year(
    spark: SparkSession,
    year: int | str,
    inputs: Inputs,
    lake: Lake,
    rules: Sequence[TableRule] = DEFAULT_RULES,
    fail_fast: bool = False,
    all_summaries: bool = False,
    check_numbers: bool = True,
    per_file: bool = True,
) -> list[Row]:
    """Load a year and return the report of the checks.

    Nothing of the live tables changes before the checks of the staged ones have passed; then
    all change at once. A failed check raises ``DataQualityError``; the checks include text that
    is no number in the CSV inputs unless ``check_numbers`` is off.

    Month files that did not change since this year was loaded are not read again; a changed
    ports file counts as a change of all. The summaries of exactly those years are replaced that
    the changed parts of the fact hold. ``all_summaries`` rebuilds every year, which shows
    changed labels everywhere. ``per_file``: see ``clean_arrivals``; without it all files of the
    year are one unit.

    Two loads at a time: the one that publishes second raises ``ConcurrentChangeError`` and has
    changed nothing.
    """
    before = current(spark, lake)
    staged = before.next()
    numbers = stage_dimensions(spark, inputs, lake, staged)
    touched, of_arrivals = stage_months(spark, year, inputs, lake, staged, per_file)
    removed, added = stage_fact(spark, year, lake, staged, touched)
    new = not before.number
    if removed or added or new:
        stage_views(spark, lake, staged, removed, added)
        stage_dates(spark, lake, staged)
    lines = [*numbers, *of_arrivals] if check_numbers else []
    report = audit(spark, lake, staged, rules, fail_fast, lines)
    if all_summaries or new:
        stage_summaries(spark, lake, staged)
    elif removed or added:
        years = {None if y == "None" else int(y) for y, _, _ in (p.partition(",") for p in touched)}
        of_dates = _weekday_years(spark, lake, touched, (before, staged))
        stage_summaries(spark, lake, staged, years, of_dates)
    publish(spark, lake, staged)
    return report

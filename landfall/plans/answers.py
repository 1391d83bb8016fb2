"""Questions asked of the star schema. ``k`` limits the reports that are top-k by nature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.dedupe import first_per_key
from landfall.operators.enrich import enrich
from landfall.operators.summarise import largest_first, sum_by, top
from landfall.plans.stats import YEAR, country_sums, visa_sums, weekday_sums

# Calendar order of the short weekday names.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

DEMOGRAPHICS = [
    "Median_Age",
    "Male_Population",
    "Female_Population",
    "Total_Population",
    "Number_of_Veterans",
    "Average_Household_Size",
]


def _place(city: str, state: str) -> Column:
    return F.concat(F.upper(city), F.lit("\t"), F.col(state))


def top_visas(fact: DataFrame, visas: DataFrame, k: int = 10) -> DataFrame:
    """Which visas are used most."""
    keys = ["Visa_Type", "Visa_Purpose"]
    return top(sum_by(visa_sums(fact, visas), keys, "sum_count"), k, keys)


def top_ports(fact: DataFrame, k: int = 10) -> DataFrame:
    """Which ports of entry see most arrivals."""
    keys = ["port_of_entry", "City", "State"]
    return top(sum_by(fact, keys), k, keys)


def top_countries(fact: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    """From which countries most travellers come."""
    return top(
        sum_by(country_sums(fact, countries), ["Country"], "sum_count"), k, ["Country"]
    )


def weekday_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Arrivals per year and weekday in calendar order, Monday being 1."""
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    position = F.nullif(F.array_position(names, F.col("weekday")).cast("int"), F.lit(0))
    numbered = weekday_sums(fact, dates).withColumn("weekday_number", position)
    return numbered.select(YEAR, "weekday_number", "weekday", "sum_count").orderBy(
        YEAR, "weekday_number"
    )


def monthly_inflow(fact: DataFrame) -> DataFrame:
    """Which time of the year brings more arrivals."""
    keys = [YEAR, "arrival_date_month"]
    return sum_by(fact, keys).orderBy(*keys)


def busiest_days(fact: DataFrame, k: int = 10) -> DataFrame:
    """Which days bring most arrivals."""
    return top(sum_by(fact, ["arrival_date"]), k, ["arrival_date"])


def city_inflow_demographics(fact: DataFrame, cities: DataFrame) -> DataFrame:
    """Arrivals per city with the city's demographics, the largest inflow first.

    Cities match on the capitalised name and the state code. One demographics row is kept per
    such pair, so no arrival counts twice.
    """
    inflow = sum_by(fact, ["City", "State"]).withColumn("_place", _place("City", "State"))
    places = first_per_key(
        cities.select(_place("City", "State_Code").alias("_place"), *DEMOGRAPHICS), ["_place"]
    )
    joined = enrich(inflow, places, "_place", "_place", DEMOGRAPHICS)
    return largest_first(
        joined.select("City", "State", "sum_count", *DEMOGRAPHICS), ["City", "State"]
    )

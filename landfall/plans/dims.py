"""Dimension tables.

Lookup files may say the same row by row many times: equal rows of the columns that are used are
counted first, a hash aggregate in each task, so that texts are cleaned and sorted once per
different row and not once per row of the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import (
    ascii_only,
    clean_city_text,
    clean_code,
    clean_state_code,
    clean_state_text,
    collapse_spaces,
    day_number_to_date,
    day_of_month,
    text_to_int,
    to_int,
    weekday_name,
)
from landfall.operators.dedupe import first_per_key
from landfall.operators.shape import quoted, rename_columns

# Column names of the demographics file and of the city dimension.
CITY_COLUMNS = {
    "City": "City",
    "State": "State",
    "State Code": "State_Code",
    "Median Age": "Median_Age",
    "Male Population": "Male_Population",
    "Female Population": "Female_Population",
    "Total Population": "Total_Population",
    "Number of Veterans": "Number_of_Veterans",
    "Average Household Size": "Average_Household_Size",
}


#: How often a row stands in a lookup file.
TIMES = "_times"


def _seen(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The different rows of ``columns``, with their number of rows.

    The number goes on into the choice of the row per key, behind all other columns, where it
    decides nothing; without it the optimizer would drop this step for the choice.
    """
    return raw.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias(TIMES))


def dim_visas(raw: DataFrame) -> DataFrame:
    """Visa types and their purposes, unique on the cleaned type."""
    cleaned = _seen(raw, ["Visa Type", "Purpose"]).select(
        clean_code("Visa Type").alias("Visa_Type"),
        ascii_only("Purpose").alias("Visa_Purpose"),
        TIMES,
    )
    return first_per_key(cleaned, ["Visa_Type"]).drop(TIMES)


def dim_countries(raw: DataFrame) -> DataFrame:
    """Countries, unique on the code. A code that is no number becomes null."""
    is_text = dict(raw.dtypes)["Country_code"] == "string"
    code = (text_to_int if is_text else to_int)("Country_code")
    seen = _seen(raw, ["Country_code", "Country"])
    rows = seen.select(code.alias("Country_code"), "Country", TIMES)
    return first_per_key(rows, ["Country_code"]).drop(TIMES)


def dim_cities(raw: DataFrame) -> DataFrame:
    """City demographics, unique on city and state."""
    cleaned = raw.withColumn("State Code", clean_state_code("State Code"))
    return first_per_key(rename_columns(cleaned, CITY_COLUMNS), ["City", "State"])


def dim_ports(raw: DataFrame, collapse_all: bool = False) -> DataFrame:
    """Ports of entry with city and state, unique on the cleaned code."""
    cleaned = _seen(raw, ["Code", "City", "State"]).select(
        clean_code("Code").alias("Code"),
        collapse_spaces(clean_city_text("City"), collapse_all).alias("City"),
        collapse_spaces(clean_state_text("State"), collapse_all).alias("State"),
        TIMES,
    )
    return first_per_key(cleaned, ["Code"]).drop(TIMES)


def dim_dates(arrivals: DataFrame) -> DataFrame:
    """Arrival dates with their parts, unique on the date.

    ``arrivals`` may be the cleaned arrivals, de-duplicated or not, or the fact: all hold the
    same dates. Year and month are those of the arrival record. Arrivals are first counted by
    day, year and month, a hash aggregate in each task that leaves a few rows per day. The count
    goes into the choice of the row, behind year and month, where it decides nothing; without
    it the optimizer would drop the first step and sort all arrivals for the second.
    """
    day = "arrdate" if "arrdate" in arrivals.columns else "arrival_date"
    parts = [day, "arrival_date_year", "arrival_date_month"]
    seen = arrivals.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"))
    if day == "arrdate":
        # The date text is made once per day, not once per arrival.
        seen = seen.withColumn("arrival_date", day_number_to_date(day)).drop(day)
    seen = seen.select("arrival_date", *parts[1:], "rows")
    return first_per_key(seen, ["arrival_date"]).select(
        "arrival_date",
        "arrival_date_year",
        "arrival_date_month",
        day_of_month("arrival_date").alias("arrival_date_day"),
        weekday_name("arrival_date").alias("weekday"),
    )

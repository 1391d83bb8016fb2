"""Declared schemas of every input and output table."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
}


def _schema(**columns: str) -> StructType:
    return _named(columns)


def _named(columns: dict[str, str]) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Inputs. Column names are fixed values: they are the headers of the landing files.

RAW_ARRIVALS = _schema(
    i94mode="double",
    i94res="double",
    i94port="string",
    arrdate="double",
    i94yr="double",
    i94mon="double",
    i94bir="double",
    visatype="string",
)

# Of arrivals read from monthly files: the number of the file's month.
FILE_MONTH = "file_month"

RAW_PORTS = _schema(Code="string", City="string", State="string")

RAW_VISAS = _named({"Visa Type": "string", "Purpose": "string"})

# The code stays text here so that a junk code survives the scan and is seen by the checks.
RAW_COUNTRIES = _schema(Country_code="string", Country="string")

RAW_DEMOGRAPHICS = _named(
    {
        "City": "string",
        "State": "string",
        "State Code": "string",
        "Median Age": "double",
        "Male Population": "int",
        "Female Population": "int",
        "Total Population": "int",
        "Number of Veterans": "int",
        "Average Household Size": "double",
    }
)

# Outputs. Table and column names are fixed values: readers of the lake rely on them.

VISAS = _schema(Visa_Type="string", Visa_Purpose="string")

COUNTRIES = _schema(Country_code="int", Country="string")

CITIES = _schema(
    City="string",
    State="string",
    State_Code="string",
    Median_Age="double",
    Male_Population="int",
    Female_Population="int",
    Total_Population="int",
    Number_of_Veterans="int",
    Average_Household_Size="double",
)

DATES = _schema(
    arrival_date="string",
    arrival_date_year="int",
    arrival_date_month="int",
    arrival_date_day="int",
    weekday="string",
)

FACT = _schema(
    country_of_residence_cd="int",
    port_of_entry="string",
    visatype="string",
    arrival_date="string",
    arrival_date_year="int",
    arrival_date_month="int",
    age_group="string",
    City="string",
    State="string",
    count="long",
)

LAKE_TABLES = {
    "US_Visas": VISAS,
    "country_codes": COUNTRIES,
    "cities_demographics": CITIES,
    "arrival_dates": DATES,
    "immigration_fact": FACT,
}

SUMMARY_TABLES = {
    "weekday": _schema(arrival_date_year="int", weekday="string", sum_count="long"),
    "visa": _schema(
        arrival_date_year="int", Visa_Type="string", Visa_Purpose="string", sum_count="long"
    ),
    "country": _schema(arrival_date_year="int", Country="string", sum_count="long"),
    "city": _schema(arrival_date_year="int", City="string", State="string", sum_count="long"),
}

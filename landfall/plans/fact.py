"""Cleaned arrivals and the counted fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import age_group, clean_code, day_number_to_date, to_int
from landfall.functions.dates import valid_day_number
from landfall.operators.dedupe import distinct_of
from landfall.operators.enrich import enrich
from landfall.schemas import FACT, FILE_MONTH

AIR = 1

# What identifies an arrival, by the names of the landing files.
ARRIVAL_COLUMNS = ["i94res", "i94port", "arrdate", "i94yr", "i94mon", "i94bir", "visatype"]


def air_arrivals(raw: DataFrame) -> DataFrame:
    """Arrivals by air, by the mode as recorded: 1.9 is not air, though it casts to 1.

    The bare comparison reaches the Parquet scan as a pushed filter.
    """
    return raw.where(F.col("i94mode") == AIR)


def project_arrivals(raw: DataFrame) -> DataFrame:
    """The columns that identify a traveller's arrival."""
    return raw.select(*ARRIVAL_COLUMNS)


def clean_arrivals(
    raw: DataFrame,
    dedupe: bool = True,
    zero_is_infant: bool = False,
    per_file: bool = True,
    keep_file: bool = False,
) -> DataFrame:
    """Air arrivals with typed columns, date text and age band.

    Rows that agree in all recorded values are one arrival (``dedupe``). That is decided
    before cleaning, so rows that become equal only by cleaning stay apart. Where ``raw`` tells
    the month file of a row, equal rows of two files are two arrivals; without ``per_file`` they
    are one. ``keep_file`` keeps the column that tells it.
    """
    air = air_arrivals(raw)
    kept = [FILE_MONTH] if keep_file else []
    rows = air.select(*ARRIVAL_COLUMNS, *kept)
    if dedupe:
        by_file = [FILE_MONTH] if per_file and FILE_MONTH in raw.columns else []
        rows = distinct_of(air, [*ARRIVAL_COLUMNS, *by_file])
    typed = rows.select(
        *kept,
        to_int("i94res").alias("country_of_residence_cd"),
        clean_code("i94port").cast("string").alias("port_of_entry"),
        valid_day_number("arrdate").alias("arrdate"),
        to_int("i94bir").alias("i94bir"),
        clean_code("visatype").alias("visatype"),
        to_int("i94yr").alias("arrival_date_year"),
        to_int("i94mon").alias("arrival_date_month"),
    )
    return typed.withColumns(
        {
            "arrival_date": day_number_to_date("arrdate"),
            "age_group": age_group("i94bir", zero_is_infant),
        }
    )


def join_port(arrivals: DataFrame, ports: DataFrame) -> DataFrame:
    """Arrivals with the city and state of their port, null for an unknown port."""
    return enrich(arrivals, ports, "port_of_entry", "Code", ["City", "State"])


def fact_arrivals(
    clean: DataFrame, ports: DataFrame, also: Sequence[str] = ()
) -> DataFrame:
    """Arrivals counted per country, port, visa, date, month, age band, city and state, and by
    the columns ``also``.

    A port's code fixes its city and state (``ports`` is unique on ``Code``), so arrivals are
    counted by the other keys first and the two columns are joined to the counted groups:
    narrower rows in the shuffle and fewer rows in the join. The day number stands for the
    date text until then.
    """
    counted = clean.groupBy(
        *also,
        "country_of_residence_cd",
        "port_of_entry",
        "visatype",
        "arrdate",
        "arrival_date_year",
        "arrival_date_month",
        "age_group",
    ).agg(F.count(F.lit(1)).alias("count"))
    dated = counted.withColumn("arrival_date", day_number_to_date("arrdate"))
    return join_port(dated, ports).select(*also, *FACT.names)

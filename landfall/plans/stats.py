"""Summaries of the fact.

Counts are summed by the fact's own key before a dimension is joined, so each join sees a few
rows per key and year whatever the size of the fact, and a hot or null key is already one row.
With ``years`` only those partitions of the fact are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.enrich import enrich
from landfall.operators.summarise import largest_first, sum_by

YEAR = "arrival_date_year"


def of_years(df: DataFrame, years: Iterable[int | None] | None) -> DataFrame:
    """Rows of the given years, of which None is the null year; all rows without ``years``."""
    if years is None:
        return df
    years = list(years)
    known = F.col(YEAR).isin([year for year in years if year is not None])
    return df.where(known | F.col(YEAR).isNull() if None in years else known)


def _labelled(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    labels: Sequence[str],
) -> DataFrame:
    per_key = sum_by(fact, [YEAR, fact_key])
    named = enrich(per_key, dimension, fact_key, dimension_key, labels)
    return sum_by(named, [YEAR, *labels], "sum_count")


def weekday_sums(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sum per year and weekday, both taken from the date dimension."""
    per_date = sum_by(fact, ["arrival_date"])
    named = enrich(per_date, dates, "arrival_date", "arrival_date", [YEAR, "weekday"])
    return sum_by(named, [YEAR, "weekday"], "sum_count")


def stats_weekday(
    fact: DataFrame, dates: DataFrame, years: Iterable[int] | None = None
) -> DataFrame:
    """Arrivals per year and weekday, the busiest first.

    The year is the date dimension's, so ``years`` is applied after the join; a date missing
    there counts under a null year and weekday.
    """
    return largest_first(of_years(weekday_sums(fact, dates), years), [YEAR, "weekday"])


def visa_sums(fact: DataFrame, visas: DataFrame) -> DataFrame:
    return _labelled(fact, visas, "visatype", "Visa_Type", ["Visa_Type", "Visa_Purpose"])


def stats_visa(
    fact: DataFrame, visas: DataFrame, years: Iterable[int] | None = None
) -> DataFrame:
    """Arrivals per year, visa type and purpose; unknown types form one null group a year."""
    sums = visa_sums(of_years(fact, years), visas)
    return largest_first(sums, [YEAR, "Visa_Type", "Visa_Purpose"])


def country_sums(fact: DataFrame, countries: DataFrame) -> DataFrame:
    return _labelled(fact, countries, "country_of_residence_cd", "Country_code", ["Country"])


def stats_country(
    fact: DataFrame, countries: DataFrame, years: Iterable[int] | None = None
) -> DataFrame:
    """Arrivals per year and country name; codes that share a name are one group."""
    return largest_first(country_sums(of_years(fact, years), countries), [YEAR, "Country"])


def stats_city(fact: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Arrivals per year, city and state; ports of one city are one group."""
    sums = sum_by(of_years(fact, years), [YEAR, "City", "State"])
    return largest_first(sums, [YEAR, "City", "State"])

"""Day numbers counted from 1960-01-01, and parts of ISO date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.numbers import to_int

EPOCH = "1960-01-01"
# Day numbers of 0001-01-01 and 9999-12-31; others have no yyyy-MM-dd form.
FIRST_DAY = -715509
LAST_DAY = 2936549


def valid_day_number(days: Column | str) -> Column:
    """Day number as int, null when it lies outside the four-digit years."""
    number = to_int(days)
    return F.when(number.between(FIRST_DAY, LAST_DAY), number)


def day_number_to_date(days: Column | str) -> Column:
    """Day number to ``yyyy-MM-dd`` text; null stays null."""
    return F.date_add(F.lit(EPOCH).cast("date"), valid_day_number(days)).cast("string")


def day_of_month(date_text: Column | str) -> Column:
    return F.dayofmonth(F.to_date(date_text))


def weekday_name(date_text: Column | str) -> Column:
    """Short English weekday name, ``Mon`` to ``Sun``."""
    return F.date_format(F.to_date(date_text), "E")

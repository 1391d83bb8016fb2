"""Casts that give null for a bad value instead of stopping the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_int(number: Column | str) -> Column:
    """Numeric column to int, cut towards zero; out of range or NaN gives null."""
    return _column(number).try_cast("int")


def text_to_double(text: Column | str) -> Column:
    """Text to double: white space of any kind around it, thousands marked by commas and an
    exponent are read; what is no number then is null."""
    bare = F.regexp_replace(_column(text), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    grouped = bare.rlike(r"^[+-]?[0-9]{1,3}(,[0-9]{3})+([.][0-9]*)?$")
    plain = F.when(grouped, F.replace(bare, F.lit(","), F.lit(""))).otherwise(bare)
    number = plain.rlike(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(number, plain.try_cast("double"))


def text_to_int(text: Column | str) -> Column:
    """Text to int by way of double: the decimal part is cut off, no number gives null."""
    return to_int(text_to_double(text))


def bad_number(text: Column | str, number: Column) -> Column:
    """Whether there is text that gave no number; white space alone is no text."""
    return _column(text).rlike(r"[^\s\p{Z}]") & number.isNull()

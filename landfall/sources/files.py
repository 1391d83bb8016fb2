"""Scans."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from landfall.functions import bad_number, text_to_double, text_to_int
from landfall.operators.shape import quoted
from landfall.schemas import FILE_MONTH, RAW_ARRIVALS

# Month tokens and the name of a monthly arrivals file.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_FILE = "i94_{month}{yy}_sub"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header line.

    Columns of ``schema`` are found by header name, so the file may hold others and in any
    order; only the header line is read for that. Numbers are read as text and converted
    (``text_to_double``), so padded, decimal and grouped figures are kept; text that is no
    number gives null and is counted by ``bad_numbers``. Without ``schema`` the types are
    inferred, which costs a full extra pass.
    """
    if schema is None:
        return spark.read.options(header=True, sep=sep, inferSchema=True).csv(path)
    return typed(read_csv_text(spark, path, schema, sep), schema)


def read_csv_text(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ","
) -> DataFrame:
    """The columns of ``schema`` as the text that the file holds."""
    return _text_scan(spark, path, schema, sep).select(
        *[F.col(quoted(name)) for name in schema.names]
    )


def _text_scan(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ","
) -> DataFrame:
    options = {"header": True, "sep": sep}
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    in_file_order = StructType([StructField(name, StringType()) for name in header])
    return spark.read.options(**options, enforceSchema=False).schema(in_file_order).csv(path)


def _number(name: str, kind: DataType) -> Column | None:
    """The number that a text column holds, None for a column of text."""
    if isinstance(kind, StringType):
        return None
    return (text_to_int if isinstance(kind, IntegerType) else text_to_double)(quoted(name))


def typed(text: DataFrame, schema: StructType) -> DataFrame:
    """Text columns in the types of ``schema`` (text, int or double); others are kept as they
    are."""
    declared = {field.name: _number(field.name, field.dataType) for field in schema}
    numbers = {name: n.alias(name) for name, n in declared.items() if n is not None}
    return text.select(*[numbers.get(name, F.col(quoted(name))) for name in text.columns])


def bad_numbers(text: DataFrame, schema: StructType) -> dict[str, Column]:
    """For each number column of ``schema`` whether a row's text there is no number."""
    columns = {field.name: _number(field.name, field.dataType) for field in schema}
    return {
        name: bad_number(quoted(name), number)
        for name, number in columns.items()
        if number is not None
    }


def month_paths(
    root: str,
    year: int | str,
    months: Sequence[str] = MONTHS,
    name: str = MONTH_FILE,
    suffix: str = "",
) -> list[str]:
    """Paths of the monthly files of a year."""
    yy = str(year)[2:]
    return [f"{root.rstrip('/')}/{name.format(month=m, yy=yy)}{suffix}" for m in months]


def _file_month(name: str, year: int | str, suffix: str) -> Column:
    """The number, from 1, of the month whose file a row came from, read off the file's path."""
    pattern = re.escape(name).replace(re.escape("{month}"), f"({'|'.join(MONTHS)})")
    pattern = pattern.replace(re.escape("{yy}"), str(year)[2:])
    token = F.regexp_extract(F.col("_metadata.file_path"), f"{pattern}{re.escape(suffix)}(?:/|$)", 1)
    return F.array_position(F.array(*map(F.lit, MONTHS)), token).cast("int").alias(FILE_MONTH)


def read_arrivals_text(
    spark: SparkSession,
    root: str,
    year: int | str,
    months: Sequence[str] = MONTHS,
    file_format: str = "csv",
    name: str = MONTH_FILE,
    suffix: str = "",
) -> DataFrame:
    """Arrivals of CSV month files as the text that they hold, with ``file_month``."""
    scan = _text_scan(spark, month_paths(root, year, months, name, suffix), RAW_ARRIVALS)
    columns = [F.col(quoted(column)) for column in RAW_ARRIVALS.names]
    return scan.select(*columns, _file_month(name, year, suffix))


def read_arrivals(
    spark: SparkSession,
    root: str,
    year: int | str,
    months: Sequence[str] = MONTHS,
    file_format: str = "parquet",
    name: str = MONTH_FILE,
    suffix: str = "",
) -> DataFrame:
    """Arrivals of the given months of a year as one scan over all their files.

    ``file_month`` is the number, from 1, of the month whose file a row came from; it is read
    off the file's path.
    """
    if file_format == "csv":
        text = read_arrivals_text(spark, root, year, months, file_format, name, suffix)
        return typed(text, RAW_ARRIVALS)
    paths = month_paths(root, year, months, name, suffix)
    scan = spark.read.schema(RAW_ARRIVALS).format(file_format).load(paths)
    return scan.select(*RAW_ARRIVALS.names, _file_month(name, year, suffix))


def read_table(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None
) -> DataFrame:
    """Parquet table; with ``schema`` an empty folder reads as an empty table."""
    paths = [path] if isinstance(path, str) else path
    if schema is None:
        return spark.read.parquet(*paths)
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)

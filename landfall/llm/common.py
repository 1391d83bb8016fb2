"""Shared pieces: stored stages, fold remainders, fresh column names, words as bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sources.scratch import scratch_folder

#: Lower-cases A-Z and leaves every other byte of UTF-8 as it is.
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 256


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    It cuts the lineage: a lost executor costs the tasks that read it, not the work behind it,
    and values such as row ids are the same in every later reading.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column of ``taken`` is called so."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short pieces of a batch, so that the Python objects of few rows exist at once."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def utf8(text: str | None) -> bytes:
    """The text's UTF-8 bytes; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, as UTF-8 bytes."""
    return utf8(text).translate(FOLD).split()

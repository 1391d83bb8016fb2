"""Removing duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.shape import quoted


def distinct_of(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, over a projection if ``columns`` are given."""
    return (df if columns is None else df.select(*columns)).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns in their order, nulls first.

    The order covers every column, so the row kept is the same on every run. It is planned as
    a partial and a final minimum: each map task sends at most one row per key, so a key that
    holds a large part of the table does not gather in one task. The minimum of whole rows is
    not a hash aggregate: each task sorts its rows by key first. Where many rows share few
    keys, count or group them by all columns before.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    smallest = F.min(F.struct(*[F.col(quoted(name)) for name in others])).alias("_row")
    picked = df.groupBy(*[F.col(quoted(name)) for name in keys]).agg(smallest)
    return picked.select(
        *[
            F.col(quoted(name)) if name in keys else F.col("_row").getField(name).alias(name)
            for name in df.columns
        ]
    )

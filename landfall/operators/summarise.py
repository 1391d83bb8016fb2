"""Sums of the fact's counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], amount: str = "count") -> DataFrame:
    """Sum of ``amount`` per group as ``sum_count``."""
    return df.groupBy(*keys).agg(F.sum(amount).alias("sum_count"))


def largest_first(df: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Sort by ``sum_count`` downwards; equal sums follow ``ties``, so the order is total."""
    return df.orderBy(F.desc("sum_count"), *ties)


def top(df: DataFrame, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``sum_count``."""
    return largest_first(df, ties).limit(k)

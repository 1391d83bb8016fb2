"""Projection helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select the columns of ``names`` in its order, each under its new name."""
    return df.select(*[F.col(quoted(old)).alias(new) for old, new in names.items()])

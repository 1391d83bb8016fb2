"""Left outer join of facts to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NonUniqueKeyError(ValueError):
    """A dimension repeats a key, so a join on it would multiply rows."""


def enrich(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    columns: Sequence[str],
    check_unique: bool = False,
) -> DataFrame:
    """All rows of ``fact`` with ``columns`` of the matching dimension row, null if none.

    There is no broadcast hint: Spark broadcasts the dimension when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a sort-merge join, whose hot
    keys adaptive execution splits. Only the key and ``columns`` of the dimension take part.
    """
    if check_unique:
        repeated = dimension.groupBy(dimension_key).count().where(F.col("count") > 1)
        if not repeated.isEmpty():
            raise NonUniqueKeyError(f"dimension key {dimension_key} is not unique")
    clash = [c for c in columns if c in fact.columns]
    if clash:
        raise ValueError(f"columns already present: {', '.join(clash)}")
    side = dimension.select(
        F.col(dimension_key).alias("_key"), *[F.col(c).alias(f"_dim_{c}") for c in columns]
    )
    return fact.join(side, F.col(fact_key) == F.col("_key"), "left").select(
        *fact.columns, *[F.col(f"_dim_{c}").alias(c) for c in columns]
    )

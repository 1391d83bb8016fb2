"""Sums that are kept up to date by what was removed and what was added.

A view holds, per group of its keys, the number of rows and the sum of their counts. Both can be
taken back, so a change of the table costs a pass over the rows that changed, not over the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

ROWS, TOTAL = "n_rows", "sum_count"


@dataclass(frozen=True)
class AdditiveView:
    """The sums of ``amount`` by ``keys``, of which null is a value like any other."""

    keys: tuple[str, ...]
    amount: str = "count"

    def schema(self, table: StructType) -> StructType:
        measures = [StructField(ROWS, LongType()), StructField(TOTAL, LongType())]
        return StructType([*[table[key] for key in self.keys], *measures])

    def of(self, rows: DataFrame) -> DataFrame:
        """The view of a whole table."""
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(ROWS), F.sum(self.amount).alias(TOTAL)
        )

    def changed(self, view: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
        """The view after rows were taken out of its table and others put in. Groups that have no
        row any more are left out."""
        gone = self.of(removed).withColumns({c: -F.col(c) for c in (ROWS, TOTAL)})
        sums = view.unionByName(gone).unionByName(self.of(added)).groupBy(*self.keys)
        return sums.agg(F.sum(ROWS).alias(ROWS), F.sum(TOTAL).alias(TOTAL)).where(
            F.col(ROWS) != 0
        )

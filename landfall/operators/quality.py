"""Checks that stop a run before bad tables are summarised."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from landfall.operators.shape import quoted

log = logging.getLogger("landfall.quality")

NOT_EMPTY = "not_empty"
NOT_NULL = "not_null"
UNIQUE = "unique"
BAD_NUMBER = "bad_number"

#: Columns of a report.
REPORT = (
    "table_name string, check_name string, column_name string, passed boolean, bad_rows long"
)


@dataclass(frozen=True)
class TableRule:
    """What must hold for a table: rows, no null in any key column, optionally unique keys."""

    table: str
    keys: tuple[str, ...] = ()
    unique: bool = False


# Tables and key columns of the lake. The fact is checked for rows only.
DEFAULT_RULES = (
    TableRule("cities_demographics", ("City", "State")),
    TableRule("country_codes", ("Country_code",)),
    TableRule("US_Visas", ("Visa_Type",)),
    TableRule("arrival_dates", ("arrival_date",)),
    TableRule("immigration_fact"),
)


class DataQualityError(ValueError):
    """At least one check failed; ``failures`` holds the failing report rows."""

    def __init__(self, failures: Sequence[Row]):
        self.failures = list(failures)
        lines = [
            f"{row.check_name} failed for table {row.table_name}"
            + (f", key {row.column_name}" if row.column_name else "")
            + (f": {row.bad_rows} rows" if row.bad_rows else "")
            for row in self.failures
        ]
        super().__init__("; ".join(lines))


def _line(table: str, check: str, column: str | None, passed: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        passed.alias("passed"),
        bad.cast("long").alias("bad_rows"),
    )


def _lines(counts: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def _union(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _table_report(df: DataFrame, rule: TableRule, rows: bool = True) -> DataFrame:
    """All checks of a table in one pass over it.

    Without the uniqueness check that is a plain aggregate. With it the rows are first counted
    per key, with a partial count in each task, and the other checks weigh those counts.
    """
    keys = [F.col(quoted(key)) for key in rule.keys]
    unique = rule.unique and bool(keys)
    if unique:
        df_counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        rows_where = lambda condition: F.sum(F.when(condition, F.col("_n")))
    else:
        df_counts = df
        rows_where = F.count_if
    aggregates = [F.coalesce(rows_where(F.lit(True)), F.lit(0)).alias("n_rows")]
    for i, key in enumerate(keys):
        aggregates.append(F.coalesce(rows_where(key.isNull()), F.lit(0)).alias(f"nulls_{i}"))
    if unique:
        aggregates.append(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"))

    lines = []
    if rows:
        passed = (F.col("n_rows") > 0) & F.lit(len(df.columns) > 0)
        lines.append(_line(rule.table, NOT_EMPTY, None, passed, F.lit(0)))
    for i, key in enumerate(rule.keys):
        bad = F.col(f"nulls_{i}")
        lines.append(_line(rule.table, NOT_NULL, key, bad == 0, bad))
    if unique:
        bad = F.col("repeated")
        lines.append(_line(rule.table, UNIQUE, ", ".join(rule.keys), bad == 0, bad))
    return _lines(df_counts.agg(*aggregates), lines)


def row_count_report(tables: Mapping[str, DataFrame], rules: Sequence[TableRule]) -> DataFrame:
    """Number of columns and rows of each table, and whether there are any."""
    counts = []
    for rule in rules:
        df = tables[rule.table]
        rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
        width = len(df.columns)
        counts.append(
            rows.select(
                F.lit(rule.table).alias("table_name"),
                F.lit(width).alias("n_columns"),
                "n_rows",
                ((F.col("n_rows") > 0) & F.lit(width > 0)).alias("passed"),
            )
        )
    return _union(counts)


def null_key_report(tables: Mapping[str, DataFrame], rules: Sequence[TableRule]) -> DataFrame:
    """Null count of each key column; all keys of a table are counted in one pass."""
    return _union(
        [_table_report(tables[r.table], r, rows=False) for r in rules if r.keys]
    )


def bad_number_report(
    table: str, text: DataFrame, bad: Mapping[str, Column]
) -> DataFrame:
    """One line per number column: rows whose text there is no number, in one pass.

    ``text`` and ``bad`` come from ``read_csv_text`` and ``bad_numbers``.
    """
    counts = text.agg(*[F.count_if(c).alias(f"bad_{i}") for i, c in enumerate(bad.values())])
    lines = [
        _line(table, BAD_NUMBER, name, F.col(f"bad_{i}") == 0, F.col(f"bad_{i}"))
        for i, name in enumerate(bad)
    ]
    return _lines(counts, lines)


def quality_report(
    tables: Mapping[str, DataFrame], rules: Sequence[TableRule] = DEFAULT_RULES
) -> DataFrame:
    """One row per check: ``table_name, check_name, column_name, passed, bad_rows``."""
    return _union([_table_report(tables[rule.table], rule) for rule in rules])


def enforce(
    tables: Mapping[str, DataFrame],
    rules: Sequence[TableRule] = DEFAULT_RULES,
    fail_fast: bool = False,
    also: Sequence[DataFrame] = (),
) -> list[Row]:
    """Run the checks, log each result and raise ``DataQualityError`` if any failed.

    ``also`` are further reports, such as ``bad_number_report``, that count as checks.

    By default every check runs before the error is raised; ``fail_fast`` stops at the first
    failing check of the first failing table. Only report rows come to the driver.
    """
    if fail_fast:
        batches = chain((_table_report(tables[rule.table], rule) for rule in rules), also)
    else:
        batches = iter([_union([quality_report(tables, rules), *also])])
    seen: list[Row] = []
    failures: list[Row] = []
    for batch in batches:
        for row in batch.collect():
            seen.append(row)
            subject = f"{row.check_name} {row.table_name} {row.column_name or ''}".strip()
            if row.passed:
                log.info("passed: %s", subject)
                continue
            log.error("failed: %s (%s rows)", subject, row.bad_rows)
            failures.append(row)
            if fail_fast:
                raise DataQualityError(failures)
    if failures:
        raise DataQualityError(failures)
    return seen

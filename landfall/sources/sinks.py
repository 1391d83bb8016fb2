"""Writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header line; spaces at the ends of a field are kept."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, sep=sep, **spaces).csv(path)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "dynamic"
) -> None:
    """Parquet partitioned by ``by``.

    ``dynamic`` replaces only the partitions present in ``df``, so a rerun does not repeat
    rows; ``overwrite`` replaces the whole table; ``append`` adds files.

    Rows are first gathered per partition value to avoid one small file per task and value.
    The rebalance hint lets adaptive execution split a large partition over several tasks, so
    one month holding most rows is still written in parallel.
    """
    if mode not in ("dynamic", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    gathered = df.hint("rebalance", *by)
    writer = gathered.write.partitionBy(*by)
    if mode == "append":
        writer.mode("append").parquet(path)
    else:
        kind = "dynamic" if mode == "dynamic" else "static"
        writer.mode("overwrite").option("partitionOverwriteMode", kind).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """A path and its file system, for what readers and writers of tables do not offer."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

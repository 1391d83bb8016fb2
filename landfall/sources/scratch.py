"""Folders for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path that the driver and every executor see.

    It lies in ``spark.checkpoint.dir``; where that is not set, in the folder ``scratch`` of
    the warehouse, which executors share as well. The rule is the same for every master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage is written to the shared scratch folder and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import decontaminate, language_id, near_duplicates, packing, toxicity
from landfall.llm.common import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def language_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a probability of 0.5 or more."""
    return language_id.with_known_language(docs)


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link."""
    return near_duplicates.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, each with its place in a sequence."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("language", language_known),
    ("near_duplicates", copies_out),
    ("decontamination", benchmark_out),
    ("packing", packed),
]

#: Trained models, fingerprints and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

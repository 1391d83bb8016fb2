"""The registered queries of the text operators, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    alignment,
    bloom_lm,
    decontaminate,
    id_files,
    language_id,
    licenses,
    near_duplicates,
    packing,
    phrases,
    sharding,
    token_counts,
    toxicity,
    winnowing,
)
from landfall.llm.common import read, remainder
from landfall.llm.oracle import ORACLE  # noqa: F401

SHARDS = 16


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    told = language_id.with_language(docs, language_id.fit(docs), "lang_pred", "score")
    return told.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents").select("doc_id", "text"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, folder, "labels"))
    return toxicity.with_score(docs, model).select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return bloom_lm.score(docs, remainder(7) == 2)


def op5_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return id_files.round_trip(read(spark, folder, "documents").select("doc_id", "text"))


def op6_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.compare_edits(read(spark, folder, "documents").select("doc_id", "text"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates.groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, read(spark, folder, "benchmark"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.known_digests(spark))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sixteen shards under the law ``rows``: counts at most one apart."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle_to_shards(docs, SHARDS).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents").select("lang", "text"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents").select("doc_id", "text"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(read(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_id_files": op5_id_files,
    "op6_winnowing": op6_winnowing,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_token_counts": op12_token_counts,
    "op13_alignment": op13_alignment,
}

"""Uniform shuffle into shards of exact sizes, by a matrix of hypergeometric counts.

A uniform random permutation of N rows cut into shards sends a random number of rows from each
input partition to each shard. Those numbers form a matrix with fixed row sums (the partitions'
sizes) and fixed column sums (the shards' sizes), distributed by repeated draws without
replacement. So the matrix is drawn first, from counts alone; then each partition permutes its
rows and deals them out by its line of the matrix, and each shard permutes what it received.
Only DataFrame functions touch rows; the driver holds one count per partition and shard.

The partitions are those of the scan of the stored input. A local sort by noise permutes each of
them where it lies, and a row's place in it tells its shard, so whole rows travel once: to the
bucket of their shard, where a second noise orders them.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import fresh, stored

#: Bytes that one task orders within a shard, on average; a shard has as many buckets as it needs.
BUCKET_BYTES = 64_000_000

#: Partitions whose lines of the matrix are written by one statement.
LITERAL_LINES = 4096

#: monotonically_increasing_id() counts a partition's rows in its lower bits.
PLACE_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls are good, drawn without replacement; any population size.

    Inverts the distribution over twelve standard deviations around its mode, beyond which the
    probability is below what a double can hold apart from 1.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(total - 1, 1))) ** 0.5
    reach = int(12 * spread) + 20
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype="f8")
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows that go from each part to each shard: row sums ``parts``, column sums ``shards``."""
    if sum(parts) != sum(shards):
        raise ValueError("parts and shards must hold the same number of rows")
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(parts), len(shards)), dtype="i8")
    left = list(shards)
    for p, rows in enumerate(parts):
        pool = sum(left)
        for s, room in enumerate(left):
            pool -= room
            matrix[p, s] = hypergeometric(rng, room, pool, rows)
            rows -= int(matrix[p, s])
        left = [room - int(sent) for room, sent in zip(left, matrix[p])]
    return matrix


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has: those of its texts, eight for any other column."""
    texts = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts]
    return reduce(lambda a, b: a + b, sizes, F.lit(8 * (len(df.columns) - len(texts)) + 8))


def _lines(spark: SparkSession, parts: list[int], bounds: np.ndarray, names: list[str]) -> DataFrame:
    """The matrix as a stored table: per part the running sums of its line."""
    lines = [{"p": p, "b": row} for p, row in zip(parts, bounds.tolist())]
    frames = []
    for at in range(0, max(1, len(lines)), LITERAL_LINES):
        text = F.lit(json.dumps(lines[at : at + LITERAL_LINES]))
        table = F.from_json(text, "array<struct<p:int,b:array<bigint>>>")
        frames.append(stored(spark.range(1).select(F.inline(table).alias(*names)), "shard-matrix"))
    return reduce(DataFrame.union, frames)


def shuffle_to_shards(df: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """All rows of ``df`` with columns ``shard`` (int) and ``slot`` (long, gapless from 0).

    Every assignment of rows to the places of all shards is equally likely, and the shards'
    sizes differ by one at most. Null values, equal rows and equal keys need no care: rows are
    told apart by their place in the stored input. An empty input gives no rows. Columns of the
    input called ``shard`` or ``slot`` are replaced.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    uid, part, rank, bounds, bucket, base = (
        fresh(f"lf_{n}", df.columns) for n in ("uid", "part", "rank", "bounds", "bucket", "base")
    )
    rows = stored(df.withColumn(uid, F.monotonically_increasing_id()), "shard-input")
    counted = (
        rows.groupBy(F.spark_partition_id().alias(part))
        .agg(F.count(F.lit(1)), F.sum(_row_bytes(df)))
        .collect()
    )
    counts = sorted((r[0], r[1]) for r in counted)
    total, size = sum(n for _, n in counts), sum(r[2] for r in counted)
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    lines = _lines(spark, [p for p, _ in counts], np.cumsum(matrix, axis=1), [part, bounds])
    buckets = max(1, -(-size // (n_shards * BUCKET_BYTES)))

    def noise(salt: int):
        return F.xxhash64(F.col(uid), F.lit(seed * 4 + salt))

    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    dealt = (
        rows.sortWithinPartitions(noise(1), uid)
        .select("*", F.spark_partition_id().alias(part), place.alias(rank))
        .join(lines, part)
        .withColumns(
            {
                "shard": F.size(F.filter(bounds, lambda b: b <= F.col(rank))),
                bucket: F.pmod(noise(2), F.lit(buckets)),
            }
        )
        .drop(rank, part, bounds)
    )
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        dealt.groupBy("shard", bucket)
        .agg(F.count(F.lit(1)).alias(rank))
        .select("shard", bucket, rank, F.coalesce(F.sum(rank).over(before), F.lit(0)).alias(base)),
        "shard-buckets",
    )
    found = dict(map(tuple, bases.groupBy("shard").agg(F.sum(rank)).collect()))
    if [found.get(s, 0) for s in range(n_shards)] != sizes:
        raise RuntimeError("the stored input was not split in the same way twice")
    again = Window.partitionBy("shard", bucket).orderBy(noise(3), uid)
    return (
        dealt.withColumn("slot", F.row_number().over(again) - 1)
        .join(bases.drop(rank), ["shard", bucket])
        .withColumn("slot", F.col("slot") + F.col(base))
        .select(*df.columns, "shard", "slot")
    )

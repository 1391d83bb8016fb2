"""Packing of documents into sequences of fixed length by the sum-of-squares rule.

Every piece goes where the sum of the squared numbers of open sequences per residual gap becomes
smallest. That keeps gaps of many sizes open, so that later pieces find one that fits exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import slices, stored
from landfall.llm.tokens import encoder, tokenizer_path

SEQUENCE = 1024

#: Pieces packed together, on average; the number of groups follows the input. A group leaves a
#: few sequences unfilled at its end.
GROUP_PIECES = 65_536

PIECES_SCHEMA = (
    "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: one if they fit, else full ones behind a
    first piece that takes the rest."""
    first = n % size or size
    return [(0, min(first, n))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text), with their ids if ``keep_ids``.

    A null or empty text is one piece of the end id alone; repeated rows are cut one by one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).document
        for batch in batches:
            for part in slices(batch):
                rows = []
                for uid, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    data = encode(text)
                    for number, (start, length) in enumerate(cuts(len(data) // 4, size)):
                        ids = data[4 * start : 4 * (start + length)]
                        kept = ids if keep_ids else None
                        rows.append((uid, doc_id, number, start, length, zlib.crc32(ids), kept))
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), "text"
    )
    return rows.mapInArrow(cut, PIECES_SCHEMA)


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, placed in the given order.

    A new sequence is begun only when the piece fits into none that is open. Of equally good
    places the one with the smallest gap is taken (the best fit).
    """
    open_by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    counts = np.zeros(size + 1, dtype="i8")
    sequence, offset = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        # one sequence of gap g becomes one of gap g - length; a full one is no longer counted
        there, left = counts[length:size], counts[: size - length]
        change = np.where(there > 0, 2 * (left - there) + 2, np.iinfo("i8").max)
        if len(there) and there[0]:
            change[0] = 1 - 2 * there[0]
        best = int(change.argmin()) if len(there) else 0
        if len(there) and there[best]:
            gap = length + best
            sequence[i], offset[i] = open_by_gap[gap].pop(), size - gap
            counts[gap] -= 1
        else:
            gap = size
            sequence[i], offset[i] = opened, 0
            opened += 1
        if gap > length:
            open_by_gap[gap - length].append(int(sequence[i]))
            counts[gap - length] += 1
    return sequence, offset


def pack(docs: DataFrame, path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces are dealt by a hash into groups of bounded size, so a hot source, copies or one
    very long text spread evenly; each group is packed apart, longest pieces first. Only lengths
    travel, not ids. An empty table gives no rows.
    """
    cut = stored(pieces(docs, path or tokenizer_path(), size).drop("ids"), "pieces")
    groups = max(1, -(-cut.count() // GROUP_PIECES))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("uid", "ascending"), ("piece", "ascending")]
        )
        number = table.column("group")[0].as_py()
        sequence, offset = sum_of_squares(table.column("length").to_numpy(), size)
        columns = [table.column(n) for n in names]
        return pa.table(
            [*columns, pa.array(sequence + (number << 32)), pa.array(offset)],
            names=[*names, "sequence_id", "offset"],
        )

    dealt = cut.withColumn("group", F.pmod(F.xxhash64("uid", "piece"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def sequences(packed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence, from ``pack`` and ``pieces(keep_ids=True)``
    of documents with different ids."""
    placed = packed.select("doc_id", "piece", "sequence_id", "offset").join(
        with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"]
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = F.unhex(F.array_join(F.transform(ordered, lambda p: p["ids"]), ""))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))

"""Winnowing: fingerprints of texts from rolling hashes of k-grams.

Of every ``window`` consecutive k-gram hashes the smallest is selected, the rightmost one if
several are equal, together with its position. Two texts that share any passage of
``k + window - 1`` characters therefore share a selected hash, and its positions tell where the
passage lies in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import slices

BASE = 0x5851F42D4C957F2D
MIX = np.uint64(0xFF51AFD7ED558CCD)
LOW = np.uint64(0xFFFFFFFF)
SHIFT = np.uint64(32)

#: Documents of one cell, on average, and cells at most; a cell is streamed, never held.
CELL_ROWS = 4_096
MAX_CELLS = 20_000


@dataclass(frozen=True)
class Fingerprint:
    """Selected hashes (32 bits) and their positions (code points), in text order."""

    hashes: np.ndarray
    positions: np.ndarray

    def digest(self) -> str:
        parts = np.stack([self.hashes.astype("<u8"), self.positions.astype("<u8")])
        return hashlib.sha256(parts.tobytes()).hexdigest()

    def likeness(self, other: Fingerprint) -> float:
        """Share of the different hashes of both that both have; 1 if neither has any."""
        a, b = np.unique(self.hashes), np.unique(other.hashes)
        common = len(np.intersect1d(a, b, assume_unique=True))
        total = len(a) + len(b) - common
        return common / total if total else 1.0


class Winnower:
    """Fingerprints of texts; ``k`` characters a gram, ``window`` grams a window.

    A text shorter than k is one gram; one with fewer grams than a window is one window; the
    empty text has no hash.
    """

    def __init__(self, k: int = 16, window: int = 32):
        self.k, self.window = k, window
        self.inverse = pow(BASE, -1, 2**64)
        self.up = self.down = np.ones(1, dtype="u8")

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", BASE), ("down", self.inverse)):
                powers = np.full(size, base, dtype="u8")
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype="u8"))

    def grams(self, text: str) -> np.ndarray:
        """Hash of each k-gram: a polynomial modulo 2**64, rolled by differences of a running
        sum, then mixed and cut to 32 bits."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
        n = len(codes)
        if not n:
            return codes
        k = min(self.k, n)
        self._powers(n + 1)
        sums = np.zeros(n + 1, dtype="u8")
        np.cumsum((codes + np.uint64(1)) * self.down[:n], out=sums[1:])
        rolled = (sums[k:] - sums[:-k]) * self.up[: n - k + 1]
        rolled ^= rolled >> SHIFT
        rolled *= MIX
        return rolled >> SHIFT

    def fingerprint(self, text: str | None) -> Fingerprint:
        hashes = self.grams(text or "")
        if not len(hashes):
            return Fingerprint(hashes, hashes)
        # smaller hash first, then larger position: the minimum is the rightmost smallest
        keys = (hashes << SHIFT) | (LOW - np.arange(len(hashes), dtype="u8"))
        window, span = min(self.window, len(keys)), 1
        while span * 2 <= window:
            keys = np.minimum(keys[:-span], keys[span:])
            span *= 2
        if rest := window - span:
            keys = np.minimum(keys[:-rest], keys[rest:])
        chosen = keys[np.append(True, keys[1:] != keys[:-1])]
        return Fingerprint(chosen >> SHIFT, LOW - (chosen & LOW))


def fingerprints(docs: DataFrame, k: int = 16, window: int = 32) -> DataFrame:
    """(doc_id, hashes, positions) for every row; null texts count as empty."""

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(k, window)
        for batch in batches:
            for part in slices(batch):
                found = [winnower.fingerprint(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([f.hashes.astype("i8") for f in found], pa.list_(pa.int64())),
                        pa.array([f.positions.astype("i8") for f in found], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "hashes", "positions"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        winnow, "doc_id long, hashes array<long>, positions array<long>"
    )


def in_succession(docs: DataFrame) -> DataFrame:
    """(cell, halo, doc_id, text): ``docs`` by descending id in cells that tasks can walk alone.

    Within a partition the rows of a cell stand together, in order (equal ids by text, rows
    without id last), and end with a copy of the next cell's first row (``halo``), that of the
    first cell after the last. The cells' bounds are quantiles of the ids. The text moves once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    cells = int(min(MAX_CELLS, max(1, -(-ids.count() // CELL_ROWS))))
    shares = [i / cells for i in range(1, cells)]
    quantiles = ids.agg(F.percentile_approx("doc_id", shares, 10 * cells)).first()[0] if shares else []
    bounds = spark.sparkContext.broadcast(np.unique(np.array(quantiles or [], dtype="i8")))

    @F.pandas_udf("int")
    def cell_of(column: pd.Series) -> pd.Series:
        rising = np.searchsorted(bounds.value, column.fillna(0).to_numpy("i8"), side="right")
        cell = len(bounds.value) - rising
        return pd.Series(np.where(column.isna(), len(bounds.value) + 1, cell), dtype="i4")

    placed = docs.withColumn("cell", cell_of("doc_id"))
    first = placed.groupBy("cell").agg(F.max("doc_id").alias("first_id")).orderBy("cell").collect()
    if not first:
        return placed.select("cell", F.lit(False).alias("halo"), "doc_id", "text")
    before = [first[i - 1]["cell"] for i in range(len(first))]
    heads = spark.createDataFrame(
        [(r["first_id"], b) for r, b in zip(first, before)], "first_id long, cell int"
    )
    halo = (
        docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("cell", "doc_id")
        .agg(F.min("text").alias("text"))
        .select("cell", F.lit(True).alias("halo"), "doc_id", "text")
    )
    rows = placed.select("cell", F.lit(False).alias("halo"), "doc_id", "text").unionByName(halo)
    return rows.repartition(len(first), "cell").sortWithinPartitions(
        "cell", "halo", F.desc_nulls_last("doc_id"), "text"
    )


def compare_edits(docs: DataFrame, k: int = 16, window: int = 32) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document.

    The next document is that with the next smaller id (after the last, the first); the edited
    text is the document with its last third (rounded down) replaced by as many code points of
    the next document's beginning, or by all it has. Null texts count as empty; a document that
    is alone follows itself; rows with equal ids follow each other by text, rows without id come
    last. An empty table gives no rows.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(k, window)
        last = None
        for batch in batches:
            for part in slices(batch):
                rows = []
                for cell, halo, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    print_ = winnower.fingerprint(text)
                    if last and last[0] == cell:
                        rows.append(_comparison(winnower, *last[1:], text, print_))
                    last = None if halo else (cell, doc_id, text, print_)
                if rows:
                    yield pa.RecordBatch.from_pydict(
                        dict(zip(COMPARED.names, map(list, zip(*rows)))), schema=COMPARED
                    )

    return in_succession(docs).mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _comparison(
    winnower: Winnower,
    doc_id: int | None,
    text: str,
    own: Fingerprint,
    next_text: str,
    next_print: Fingerprint,
) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + next_text[:cut]
    edited_print = winnower.fingerprint(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        own.digest(),
        edited_print.digest(),
        own.likeness(edited_print),
        own.likeness(next_print),
    )

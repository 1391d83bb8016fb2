"""Benchmark passages in documents, through a positional inverted index of the documents.

The index holds, per document, the positions of every test term in it (a document-sharded
inverted index: its lists never have to be moved to be intersected). A test window is looked up
from its rarest term: the offset-adjusted positions of that term are intersected with those of
the next rarest, and so on, until none is left or all terms agree on a start.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, slices, stored, utf8

#: Words of a full window; a shorter item is one window.
WINDOW = 10

#: Test words that are broadcast at once; beyond, the test items go over the documents in blocks.
BLOCK_WORDS = 1_000_000


def _word_table() -> bytes:
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for low, high in ((48, 57), (97, 122)):
        table[low : high + 1] = bytes(range(low, high + 1))
    table[65:91] = bytes(range(97, 123))
    return bytes(table)


#: Lower-cases A-Z and turns all that is no letter, digit or non-ASCII byte into a space.
WORD_TABLE = _word_table()

INDEX_SCHEMA = (
    "uid long, doc_id long, n_words long, "
    "postings array<struct<term: int, positions: array<int>>>"
)
HITS_SCHEMA = "uid long, doc_id long, n_words long, hits array<int>, items array<string>"


def item_words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return utf8(text).translate(WORD_TABLE).split()


@dataclass
class TestSet:
    """Windows of a block of test items, by term number; what is broadcast of the test items."""

    __test__ = False

    terms: dict[bytes, int]
    windows: dict[tuple[int, ...], list[str]]

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], window: int) -> TestSet:
        terms: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            numbers = [terms.setdefault(w, len(terms)) for w in item_words(text)]
            size = min(window, len(numbers))
            for i in range(len(numbers) - size + 1) if size else ():
                windows[tuple(numbers[i : i + size])].add(str(item_id))
        return cls(terms, {w: sorted(ids) for w, ids in windows.items()})


def _kept(terms: np.ndarray, window: int, short: np.ndarray) -> np.ndarray:
    """Positions that can be part of a window: those in a run of at least ``window`` test terms,
    and those of terms of shorter items. All others could never complete a phrase."""
    known = terms >= 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= window
    keep = np.zeros(len(terms) + 1, dtype="i4")
    np.add.at(keep, starts[long], 1)
    np.add.at(keep, ends[long], -1)
    kept = np.cumsum(keep[:-1]) > 0
    if len(short):
        kept |= known & np.isin(terms, short)
    return np.flatnonzero(kept)


def _postings(terms: np.ndarray, positions: np.ndarray) -> list[dict]:
    order = np.argsort(terms[positions], kind="stable")
    numbers, places = terms[positions][order], positions[order]
    cuts = np.flatnonzero(np.diff(numbers)) + 1
    return [
        {"term": int(t[0]), "positions": p.tolist()}
        for t, p in zip(np.split(numbers, cuts), np.split(places, cuts))
    ]


def build_index(docs: DataFrame, tests: TestSet, window: int, phrases_only: bool = True) -> DataFrame:
    """One row per row of ``docs`` (uid, doc_id, text): its number of words and its postings.

    With ``phrases_only`` positions that cannot complete a window are left out, which loses no
    phrase; proximity search needs the others as well. A null text has no words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tests)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        get = tests.terms.get
        short = np.array(sorted({t for w in tests.windows if len(w) < window for t in w}), dtype="i8")
        schema = None
        for batch in batches:
            for part in slices(batch):
                counts, postings = [], []
                for text in part.column("text").to_pylist():
                    terms = np.array([get(w, -1) for w in item_words(text)], dtype="i8")
                    counts.append(len(terms))
                    if phrases_only:
                        positions = _kept(terms, window, short)
                    else:
                        positions = np.flatnonzero(terms >= 0)
                    postings.append(_postings(terms, positions) if len(positions) else [])
                kind = pa.list_(
                    pa.struct([("term", pa.int32()), ("positions", pa.list_(pa.int32()))])
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(postings, kind),
                    ],
                    names=["uid", "doc_id", "n_words", "postings"],
                )

    return docs.select("uid", "doc_id", "text").mapInArrow(index, INDEX_SCHEMA)


def term_counts(index: DataFrame) -> dict[int, int]:
    """Occurrences of each test term in the index: at most one number per broadcast term."""
    lists = index.select(F.explode("postings").alias("p"))
    counts = lists.groupBy("p.term").agg(F.sum(F.size("p.positions")).alias("n"))
    return {r[0]: r[1] for r in counts.collect()}


def phrase_starts(
    postings: dict[int, np.ndarray], window: tuple[int, ...], order: list[int]
) -> np.ndarray:
    """Starts of ``window`` in one document; ``order``: its offsets from the rarest term on."""
    starts = None
    for offset in order:
        places = postings.get(window[offset])
        if places is None:
            return np.empty(0, dtype="i8")
        places = places - offset
        starts = places if starts is None else np.intersect1d(starts, places, assume_unique=True)
        if not len(starts):
            break
    return starts


def _by_rarest(tests: TestSet, counts: dict[int, int]) -> dict[int, list]:
    """Windows under their rarest term, with their offsets in order of rarity; windows with a
    term that no document has are left out."""
    found = defaultdict(list)
    for window, items in tests.windows.items():
        if all(t in counts for t in window):
            order = sorted(range(len(window)), key=lambda i: (counts[window[i]], window[i], i))
            found[window[order[0]]].append((window, order, items))
    return dict(found)


def match_phrases(index: DataFrame, tests: TestSet) -> DataFrame:
    """Per indexed row: the word positions inside matched windows, and the items matched."""
    shared = index.sparkSession.sparkContext.broadcast(_by_rarest(tests, term_counts(index)))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rarest = shared.value
        for batch in batches:
            for part in slices(batch):
                hits, items = [], []
                for row in part.column("postings").to_pylist():
                    lists = {p["term"]: np.array(p["positions"], dtype="i8") for p in row}
                    spans, ids = [], set()
                    for term in lists.keys() & by_rarest.keys():
                        for window, order, names in by_rarest[term]:
                            starts = phrase_starts(lists, window, order)
                            if len(starts):
                                spans.append((starts[:, None] + np.arange(len(window))).ravel())
                                ids.update(names)
                    hits.append(np.unique(np.concatenate(spans)).tolist() if spans else [])
                    items.append(sorted(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("doc_id"),
                        part.column("n_words"),
                        pa.array(hits, pa.list_(pa.int32())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["uid", "doc_id", "n_words", "hits", "items"],
                )

    return index.mapInArrow(match, HITS_SCHEMA)


def proximity_matches(docs: DataFrame, phrase: str, slop: int) -> DataFrame:
    """Documents (doc_id, start, span) in which all words of ``phrase`` stand, in any order,
    within ``slop`` words more than their number; one row per document, its tightest span first
    met. A phrase without words matches nothing.
    """
    tests = TestSet.of([(0, phrase)], max(1, len(item_words(phrase))))
    wanted = sorted(set(tests.terms.values()))
    limit = len(item_words(phrase)) + slop
    with_ids = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    index = build_index(with_ids, tests, 1, phrases_only=False)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {"doc_id": [], "start": [], "span": []}
            for doc_id, row in zip(
                batch.column("doc_id").to_pylist(), batch.column("postings").to_pylist()
            ):
                lists = {p["term"]: np.array(p["positions"]) for p in row}
                if not wanted or any(t not in lists for t in wanted):
                    continue
                rarest = min(wanted, key=lambda t: len(lists[t]))
                starts = np.unique(
                    np.concatenate([lists[rarest], *(lists[t] for t in wanted)])
                )
                ends = starts.copy()
                for t in wanted:
                    at = np.searchsorted(lists[t], starts)
                    later = np.append(lists[t], np.iinfo("i4").max)[at]
                    ends = np.maximum(ends, later)
                spans = ends - starts + 1
                if spans.min() <= limit:
                    best = int(spans.argmin())
                    found["doc_id"].append(doc_id)
                    found["start"].append(int(starts[best]))
                    found["span"].append(int(spans[best]))
            yield pa.RecordBatch.from_pydict(
                found,
                schema=pa.schema(
                    [("doc_id", pa.int64()), ("start", pa.int32()), ("span", pa.int32())]
                ),
            )

    return index.mapInArrow(near, "doc_id long, start int, span int")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window.
    ``n_hit`` counts document words inside any occurrence of a window. Null texts and texts of
    separators have no words and no hits, such items no window; an item without id is left out.
    Items with equal text or equal id count by their different ids. Repeated document rows are
    judged one by one. An empty table of either kind gives no hits.

    The test items are broadcast in blocks of about ``block_words`` words: a larger benchmark
    goes over the documents, stored once, block after block.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    n_blocks = max(1, int(size // block_words) + 1)
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    if n_blocks > 1:
        rows = stored(rows, "decontamination-documents")
    found = None
    for b in range(n_blocks):
        part = [(r[0], r[1]) for r in items.where(block == b).collect()]
        tests = TestSet.of(part, window)
        index = stored(build_index(rows, tests, window), "positional-index")
        hits = match_phrases(index, tests)
        found = hits if found is None else found.unionByName(hits)
    if n_blocks > 1:
        found = found.groupBy("uid").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any word of a benchmark window; all their columns.

    Every row is judged by itself: rows are told apart by their place in the stored input, so
    rows without id, or with one id, do not share their fate. The rows that go are stored first,
    so that the join is planned by their measured size.
    """
    uid = fresh("lf_uid", docs.columns)
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered-documents")
    judged = contamination(rows.select(F.col(uid).alias("doc_id"), "text"), benchmark)
    bad = judged.where("contaminated").select(F.col("doc_id").alias(uid))
    return rows.join(stored(bad, "contaminated-documents"), uid, "left_anti").drop(uid)

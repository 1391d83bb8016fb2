"""Bigram language model in a log-frequency Bloom filter.

An n-gram of count c is stored with its quantised count q = 1 + floor(log2 c): the pairs
(n-gram, 1) to (n-gram, q) are put into a Bloom filter. Probing (n-gram, 1), (n-gram, 2), ...
until a pair is missing gives q back, never too small and seldom too large. Probabilities use the
mean count of all n-grams with that q, so the filter alone holds the model:

    P(w | h) = a(q(h)) * count(h, w) / count(h) + (1 - a(q(h))) * (count(w) + 1) / (N + V + 1)

The weights a are those under which the training documents, each bigram's own occurrence left
out, are likeliest (deleted interpolation). All of them take part: a token's probability depends
on three quantised counts alone, those of its context, bigram and word, so a text is first turned
into the numbers of its tokens in each such cell. The cells of all training texts, summed, fit the
weights; those of each text, under these weights, are its score.

The filter is built in segments by the tasks that sum the counts. It is broadcast; its size
grows with the corpus up to a fixed number of bytes, beyond which n-grams share it more closely
and probes err more often, but none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, slices, stored, words

#: Text bytes that one segment counts, on average; the number of segments follows the corpus.
SEGMENT_BYTES = 16 << 20

#: Tokens that a counting task gathers before it sends their counts on.
GATHERED = 1_500_000

#: Bits of the filter per stored pair, probes per pair, and bytes of the whole filter at most.
PAIR_BITS = 8
PROBES = 4
MAX_FILTER_BYTES = 256 << 20

#: Words whose exact counts are broadcast at most; those of rarer words are joined.
HEAD_WORDS = 1_000_000

LEVELS = 48
#: Triples of the levels of a context, a bigram and a word.
CELLS = LEVELS**3
CACHE_WORDS = 150_000
WEIGHTS = np.array([0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])

#: Hash of the end token; no word has a blank.
END = xxhash.xxh64_intdigest(b" ")

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def bigrams(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * U(0x9E3779B97F4A7C15) + word)


def filter_keys(hashes: np.ndarray) -> np.ndarray:
    """48 bits by which the filter knows an n-gram."""
    return hashes >> U(16)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 for 1, 2 for 2 and 3, 3 for 4 to 7, ..."""
    return np.frexp(counts.astype("f8"))[1].astype("i8")


@dataclass
class Filter:
    """Segments of bits, side by side; a key belongs to the segment of its remainder."""

    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def places(keys: np.ndarray, level: int, size) -> Iterator[np.ndarray]:
        """Bit numbers, within a segment of ``size`` bits, of the pair (key, level)."""
        first = mixed(keys * U(LEVELS) + U(level))
        step = (first >> U(32)) | U(1)
        for probe in range(PROBES):
            yield ((first + step * U(probe)) & U(0xFFFFFFFFFF)) % size

    @classmethod
    def segment(cls, keys: np.ndarray, levels: np.ndarray, most_bytes: int) -> np.ndarray:
        """The bytes of a segment that holds ``keys`` with their quantised counts."""
        size = min(most_bytes, int(levels.sum()) * PAIR_BITS // 8 + 8)
        bits = np.zeros(size, dtype="u1")
        for level in range(1, int(levels.max(initial=0)) + 1):
            keys, levels = keys[levels >= level], levels[levels >= level]
            for place in cls.places(keys, level, U(size * 8)):
                at = place.astype("i8")
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype("u1"))
        return bits

    @classmethod
    def joined(cls, segments: list[np.ndarray]) -> Filter:
        sizes = np.array([len(s) for s in segments], dtype="u8")
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype("u8")
        return cls(np.concatenate(segments), starts, sizes * U(8))

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Quantised counts by repeated probes; 0 for what is not held."""
        found = np.zeros(len(hashes), dtype="i8")
        keys = filter_keys(hashes)
        part = (keys % U(len(self.sizes))).astype("i8")
        active = np.arange(len(keys))
        for level in range(1, LEVELS):
            size = self.sizes[part[active]]
            start = self.starts[part[active]]
            # the probes of one pair, each only for those that all earlier ones hit
            first = mixed(keys[active] * U(LEVELS) + U(level))
            step = (first >> U(32)) | U(1)
            for probe in range(PROBES):
                place = ((first + step * U(probe)) & U(0xFFFFFFFFFF)) % size
                byte = self.bits[(start + (place >> U(3))).astype("i8")]
                hit = (byte >> (place & U(7)).astype("u1")) & 1 == 1
                active, first, step = active[hit], first[hit], step[hit]
                size, start = size[hit], start[hit]
            if not len(active):
                break
            found[active] = level
        return found


class Words(dict):
    """Numbers of words, with an array of their hashes; forgotten as a whole when too many."""

    def __init__(self):
        super().__init__()
        self.hashes = [END]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def _packed(hashes: np.ndarray, counts: np.ndarray, order: int) -> tuple[bytes, bytes]:
    """Hashes, 8 bytes for words and 6 for bigrams, and counts of 4 bytes or 1; a bigram of a
    larger count is written several times."""
    if order == 1:
        return hashes.astype("<u8").tobytes(), counts.astype("<u4").tobytes()
    times = (counts - 1) // 255 + 1
    keys = np.repeat(filter_keys(hashes), times).astype("<u8")
    parts = np.full(len(keys), 255)
    parts[np.cumsum(times) - 1] = counts - 255 * (times - 1)
    return keys.view("u1").reshape(-1, 8)[:, :6].tobytes(), parts.astype("u1").tobytes()


def _unpacked(keys: bytes, counts: bytes, order: int) -> tuple[np.ndarray, np.ndarray]:
    if order == 1:
        return np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<u4").astype("i8")
    wide = np.zeros((len(keys) // 6, 8), dtype="u1")
    wide[:, :6] = np.frombuffer(keys, "u1").reshape(-1, 6)
    return wide.view("<u8").ravel(), np.frombuffer(counts, "u1").astype("i8")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, "u8"), np.empty(0, "i8")
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def count_segments(training: DataFrame, segments: int) -> DataFrame:
    """Counts of all words and bigrams of ``training`` (text), summed and put into segments.

    One row per segment: its part of the filter, its words with exact counts, and sums by
    quantised count. Tasks send packed arrays of different n-grams, so a frequent one costs a
    few bytes per task however often it occurs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gathered = Words(), []

        def flush() -> pa.RecordBatch:
            rows = []
            hashes = np.array(known.hashes, dtype="u8")
            numbers = np.concatenate([*gathered, np.zeros(1, "i8")])
            words = np.bincount(numbers[1:-1], minlength=len(hashes)) if gathered else hashes[:0]
            seen = np.flatnonzero(words)
            pairs = np.sort(bigrams(hashes[numbers[:-2]], hashes[numbers[1:-1]]))
            cut = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else seen
            counted = [(1, hashes[seen], words[seen])]
            counted.append((2, pairs[cut], np.diff(np.append(cut, len(pairs)))))
            for order, grams, counts in counted:
                part = (filter_keys(grams) % U(segments)).astype("i8")
                by_part = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[by_part], np.arange(segments + 1))
                for s in range(segments):
                    at = by_part[edges[s] : edges[s + 1]]
                    if len(at):
                        rows.append((s, order, *_packed(grams[at], counts[at], order)))
            gathered.clear()
            if len(known) > CACHE_WORDS:
                known.clear()
                del known.hashes[1:]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["segment", "order", "keys", "counts"],
            )

        size = 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    tokens = words(text)
                    if not gathered:
                        gathered.append(np.zeros(1, dtype="i8"))
                    gathered.append(
                        np.fromiter(map(known.__getitem__, tokens), "i8", len(tokens))
                    )
                    gathered.append(np.zeros(1, dtype="i8"))
                    size += len(tokens) + 1
                if size >= GATHERED:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    most = max(1024, MAX_FILTER_BYTES // segments)

    def merge(table: pa.Table) -> pa.Table:
        parts: dict[int, list] = {1: [], 2: []}
        for order, keys, counts in zip(
            *(table.column(c).to_pylist() for c in ("order", "keys", "counts"))
        ):
            parts[order].append(_unpacked(keys, counts, order))
        words, word_counts = _summed(parts[1])
        pairs, pair_counts = _summed(parts[2])
        keys = np.concatenate([filter_keys(words), pairs])
        levels = np.concatenate([levels_of(word_counts), levels_of(pair_counts)])
        sums, sizes = [], []
        for counts in (word_counts, pair_counts):
            sums.append(np.bincount(levels_of(counts), counts, LEVELS))
            sizes.append(np.bincount(levels_of(counts), minlength=LEVELS))
        return pa.table(
            {
                "segment": pa.array([table.column("segment")[0].as_py()], pa.int32()),
                "bits": [Filter.segment(keys, levels, most).tobytes()],
                "words": [words.astype("<u8").tobytes()],
                "word_counts": [word_counts.astype("<i8").tobytes()],
                "sums": [np.concatenate(sums).astype("i8").tolist()],
                "sizes": [np.concatenate(sizes).astype("i8").tolist()],
            }
        )

    sent = training.select("text").mapInArrow(
        count, "segment int, order int, keys binary, counts binary"
    )
    return sent.groupBy("segment").applyInArrow(
        merge,
        "segment int, bits binary, words binary, word_counts binary, sums array<long>, "
        "sizes array<long>",
    )


@dataclass
class Model:
    """What is broadcast: the filter, mean counts by level, and exact head counts."""

    filter: Filter
    means: np.ndarray
    tokens: int
    words: int
    head: np.ndarray
    head_counts: np.ndarray

    @property
    def denominator(self) -> int:
        return self.tokens + self.words + 1


class Scorer:
    """What a model holds of texts, with what it found about words kept in arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.words = Words()
        self.hashes = np.empty(0, "u8")
        self.levels = np.empty(0, "i8")
        self.exact = np.empty(0, "i8")

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
            del self.words.hashes[1:]
            self.hashes, self.levels, self.exact = self.hashes[:0], self.levels[:0], self.exact[:0]
        out = [np.fromiter(map(self.words.__getitem__, t), "i8", len(t)) for t in texts]
        new = np.array(self.words.hashes[len(self.hashes) :], dtype="u8")
        if len(new):
            head = self.model.head
            at = np.minimum(np.searchsorted(head, new), max(len(head) - 1, 0))
            exact = np.full(len(new), -1, dtype="i8")
            if len(head):
                hit = head[at] == new
                exact[hit] = self.model.head_counts[at[hit]]
            self.exact = np.concatenate([self.exact, exact])
            self.levels = np.concatenate([self.levels, self.model.filter.levels(new)])
            self.hashes = np.concatenate([self.hashes, new])
        return out

    def cells(self, numbers: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The cells of each text's tokens, in order, and how often each occurs in it."""
        end = np.zeros(1, dtype="i8")
        word = np.concatenate([x for n in numbers for x in (n, end)])
        before = np.concatenate([x for n in numbers for x in (end, n)])
        pair = self.model.filter.levels(bigrams(self.hashes[before], self.hashes[word]))
        context, single = self.levels[before], self.levels[word]
        # a bigram is no more frequent than its words
        pair = np.minimum(pair, np.minimum(context, single))
        cell = (context * LEVELS + pair) * LEVELS + single
        text = np.repeat(np.arange(len(numbers)), [len(n) + 1 for n in numbers])
        found, times = np.unique(text * CELLS + cell, return_counts=True)
        edges = np.searchsorted(found, np.arange(1, len(numbers)) * CELLS)
        return list(zip(np.split(found % CELLS, edges), np.split(times, edges)))


@dataclass
class Rates:
    """What the model knows of a cell, and all that a token's probability depends on: the
    quantised counts of the context, of the bigram and of the word."""

    means: np.ndarray
    denominator: float

    def shares(self, cells: np.ndarray, without: int = 0) -> tuple[np.ndarray, ...]:
        """Per cell the context's level, and the word's probability after the context, of whose
        counts ``without`` occurrences are left out, and by itself."""
        context, pair, word = cells // LEVELS**2, cells // LEVELS % LEVELS, cells % LEVELS
        others = np.maximum(self.means[1][pair] - without, 0)
        share = np.minimum(others / np.maximum(self.means[0][context] - without, 1), 1)
        return context, share, (self.means[0][word] + 1) / self.denominator

    def fitted(self, cells: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each level of the context the best weight of the bigram, by leave-one-out over
        tokens of which ``times`` lie in each of ``cells``."""
        context, share, single = self.shares(cells, without=1)
        total = np.zeros((LEVELS, len(WEIGHTS)))
        for i, a in enumerate(WEIGHTS):
            total[:, i] = np.bincount(
                context, times * np.log(a * share + (1 - a) * single), LEVELS
            )
        best = WEIGHTS[total.argmax(axis=1)]
        best[~total.any(axis=1)] = 0  # levels that no training text shows
        best[0] = 0  # words that the filter does not hold say nothing about the next
        return best

    def log10(self, weights: np.ndarray) -> np.ndarray:
        """The log10 probability of a token of each cell; ``weights`` by context level."""
        context, share, single = self.shares(np.arange(CELLS))
        a = weights[context]
        return np.log10(a * share + (1 - a) * single)


def count_cells(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all tokens of ``rows`` (cells, cell_times), in order, and how many tokens lie
    in each: at most ``CELLS`` numbers, whatever the rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype="i8")
        for batch in batches:
            for cells, times in zip(*(c.to_pylist() for c in batch.columns)):
                total[np.frombuffer(cells, "<u4")] += np.frombuffer(times, "<u4")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen])], names=["cell", "n"]
        )

    counted = rows.select("cells", "cell_times").mapInArrow(summed, "cell long, n long")
    found = counted.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    return np.array([r[0] for r in found], "i8"), np.array([r[1] for r in found], "i8")


def train(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model of ``training`` (doc_id, text), and exact counts (word, n) of all words that it
    does not hold them of."""
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = int(max(1, -(-size // SEGMENT_BYTES)))
    table = stored(count_segments(training, segments), "lm-segments")
    sums, sizes, parts = np.zeros(2 * LEVELS), np.zeros(2 * LEVELS), [np.zeros(1, "u1")] * segments
    for row in table.select("segment", "bits", "sums", "sizes").toLocalIterator():
        sums += row["sums"]
        sizes += row["sizes"]
        parts[row["segment"]] = np.frombuffer(bytes(row["bits"]), "u1")
    means = (sums / np.maximum(sizes, 1)).reshape(2, LEVELS)
    common = np.cumsum(sizes[:LEVELS][::-1])[::-1]  # words of a level or above
    least = int(np.flatnonzero(np.append(common, 0) <= HEAD_WORDS)[0])
    head, head_counts = _head(table, least)
    model = Model(
        Filter.joined(parts),
        means,
        int(sums[:LEVELS].sum()),
        int(sizes[:LEVELS].sum()),
        head,
        head_counts,
    )
    return model, _tail(table, least)


def _head(table: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts of the words whose level is ``least`` or more."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(counts, "<i8")
                keep = levels_of(counts) >= least
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([np.frombuffer(words, "<u8")[keep].tobytes()], pa.binary()),
                        pa.array([counts[keep].tobytes()], pa.binary()),
                    ],
                    names=["words", "word_counts"],
                )

    rows = (
        table.select("words", "word_counts")
        .mapInArrow(chosen, "words binary, word_counts binary")
        .collect()
    )
    words = np.concatenate([np.empty(0, "u8"), *(np.frombuffer(bytes(r[0]), "<u8") for r in rows)])
    counts = np.concatenate([np.empty(0, "i8"), *(np.frombuffer(bytes(r[1]), "<i8") for r in rows)])
    order = np.argsort(words)
    return words[order], counts[order]


def _tail(table: DataFrame, least: int) -> DataFrame:
    """(word, n): exact counts of the words below level ``least``."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(counts, "<i8")
                keep = levels_of(counts) < least
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(words, "<u8")[keep].view("<i8")),
                        pa.array(counts[keep]),
                    ],
                    names=["word", "n"],
                )

    return table.select("words", "word_counts").mapInArrow(chosen, "word long, n long")


SCORE_SCHEMA = (
    "uid long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, "
    "cells binary, cell_times binary, tail array<long>, times array<long>"
)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    The model, its weights included, learns from the rows where ``held_out`` is false. Null texts are empty; an empty
    text is the end token alone. Without training text every token has the probability 1 under
    the base, which then knows no word, and the model gives the same. Repeated rows count as
    often as they occur. Exact counts of frequent words come by broadcast, those of all others
    by a join.
    """
    flag = fresh("held_out", docs.columns)
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out.alias(flag),
        F.col("text").alias("text"),
    ).withColumnRenamed(flag, "held_out")
    training = rows.where(~F.col("held_out"))
    model, tail_counts = train(training)
    tokens, denominator = model.tokens, float(model.denominator)
    rates = Rates(model.means, denominator)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    del model

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, model = Scorer(shared.value), shared.value
        for batch in batches:
            for part in slices(batch, 64):
                texts = [words(t) for t in part.column("text").to_pylist()]
                numbers = scorer.numbers(texts)
                end = np.zeros(1, dtype="i8")
                known, base, tail, times = [], [], [], []
                for n in numbers:
                    counts = scorer.exact[np.append(n, end)]
                    in_head = counts >= 0
                    known.append(int(in_head.sum()))
                    base.append(float(np.log10((counts[in_head] + 1) / model.denominator).sum()))
                    rare, often = np.unique(np.append(n, end)[~in_head], return_counts=True)
                    tail.append(scorer.hashes[rare].view("i8"))
                    times.append(often)
                cells = scorer.cells(numbers)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array([len(n) + 1 for n in numbers], pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array([c.astype("<u4").tobytes() for c, _ in cells], pa.binary()),
                        pa.array([n.astype("<u4").tobytes() for _, n in cells], pa.binary()),
                        pa.array(tail, pa.list_(pa.int64())),
                        pa.array(times, pa.list_(pa.int64())),
                    ],
                    names=[
                        "uid", "doc_id", "held_out", "n_tokens", "head_known", "head_base",
                        "cells", "cell_times", "tail", "times",
                    ],
                )

    table = stored(rows.mapInArrow(scored, SCORE_SCHEMA), "lm-cells")
    shared.unpersist()
    logs = rates.log10(rates.fitted(*count_cells(table.where(~F.col("held_out")))))

    @F.pandas_udf("double")
    def log10(cells: pd.Series, times: pd.Series) -> pd.Series:
        return pd.Series(
            [
                float(logs[np.frombuffer(c, "<u4")] @ np.frombuffer(n, "<u4"))
                for c, n in zip(cells, times)
            ],
            dtype="f8",
        )

    rare = (
        table.select("uid", F.explode(F.arrays_zip("tail", "times")).alias("t"))
        .select("uid", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
        .join(tail_counts, "word", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10((F.col("n") + 1) / denominator)).alias("tail_base"),
        )
    )
    kept = table.select(
        "uid", "doc_id", "held_out", "n_tokens", "head_known", "head_base",
        log10("cells", "cell_times").alias("score"),
    )
    return kept.join(rare, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        "score",
    )

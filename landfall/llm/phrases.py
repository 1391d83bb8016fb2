"""Phrase collocations: exact counts of word sequences per language, and the scores they give.

A phrase is frequent only if its words and parts are (Apriori). The texts are read four times,
whatever their size:

1. Words are counted per language; ``n`` and the frequent words follow.
2. The pairs of frequent words are summed by hash bucket. A pair is a candidate only if its
   bucket reaches the least count: buckets only add, so no frequent pair is lost. There are
   sixteen buckets per word of the corpus, so few rare pairs pass.
3. The same for three words, at positions where both pairs lie in such buckets.
4. The phrases in the buckets that are left are dealt out by their hash, to shards of bounded
   size. A shard sums them by the whole hash, builds a double-array trie of bounded size from
   those that still reach the least count, walks all phrases that it got through the trie at once
   and counts the accepting states.

In each scan a task sums up what it finds before it sends it, packed as one row for each shard.
Broadcast are only bit tables of fixed size, which may let a rare word, pair or triple through.

Words are told apart by 64-bit hashes. Whether any two words of the corpus share one is checked;
then all is done again with another seed, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import FOLD, stored, utf8
from landfall.llm.spans import gathered, lane, lanes, mixed, span_hashes, spans
from landfall.llm.tries import Trie

#: Words of a phrase at most.
MOST_WORDS = 3
LEAST_COUNT = 10
LONGER_SHARE = 50
SCALE = 1_000_000
TOP = 2000

#: Buckets whose phrases a shard counts, and candidates of a trie, about.
BLOCK = 2_000_000
TRIE_PHRASES = 400_000

#: Phrases that a task holds before it sums them up and sends them, and words of the corpus for
#: each shard, about.
CHUNK = 1_000_000
TASK_WORDS = 2_000_000

#: Bits of the tables of frequent words, pairs and triples: 16 MB each at any size of corpus.
TABLE_BITS = 27
BITMAP = 32_768

#: Parts of a language that are ranked apart first, so that no task gets all its candidates.
RANK_PARTS = 64

NO_LANGUAGE = "und"

# What ends a piece of text, and white space between its words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
PREPARED = FOLD.translate(bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" "))

PAIR_SALT, TRIPLE_SALT = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)


def _joined(first: np.ndarray, second: np.ndarray, *third: np.ndarray) -> np.ndarray:
    """The hashes of phrases of two or three words, by the words' hashes."""
    h = mixed(first ^ mixed(second + PAIR_SALT))
    for word in third:
        h = mixed(h ^ mixed(word + TRIPLE_SALT))
    return h


@dataclass(frozen=True)
class Words:
    """The words of some texts, in order."""

    data: bytes
    start: np.ndarray
    length: np.ndarray
    hashes: np.ndarray
    #: Whether the next word stands in the same piece.
    follows: np.ndarray
    #: Of each word the place of its language in ``languages``.
    language: np.ndarray
    languages: list[str]

    def word(self, at: int) -> str:
        start = self.start[at]
        return self.data[start : start + self.length[at]].decode("utf-8", "surrogatepass")

    def languages_of(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.languages[i] for i in self.language[at].tolist()], pa.string())

    def other_than(self, like: np.ndarray) -> np.ndarray:
        """The words that are not the same word of the same language as that at ``like``."""
        same = (self.length == self.length[like]) & (self.language == self.language[like])
        view, number = lanes(self.data), 0
        live = np.flatnonzero(same)
        while len(live):
            own, its = (
                lane(view, self.start[i], self.length[i], number) for i in (live, like[live])
            )
            same[live[own != its]] = False
            number += 1
            live = live[self.length[live] > 8 * number]
        return np.flatnonzero(~same)

    def pairs(self) -> np.ndarray:
        """A hash of each word and the next."""
        return _joined(self.hashes[:-1], self.hashes[1:])

    def triples(self) -> np.ndarray:
        return _joined(self.hashes[:-2], self.hashes[1:-1], self.hashes[2:])


def words_of(batch: pa.Table, seed: int) -> Words:
    texts = [utf8(t).translate(PREPARED) for t in batch.column("text").to_pylist()]
    names, language_of = np.unique(batch.column("lang").to_pylist(), return_inverse=True)
    languages = names.tolist()
    data = b"\n".join(texts)
    letters = np.frombuffer(data, "u1")
    start, length = spans((letters != 32) & (letters != 10))
    ends = np.cumsum([len(t) + 1 for t in texts])
    language = language_of[np.searchsorted(ends, start, side="right")]
    seeds = np.array([xxhash.xxh64_intdigest(utf8(x), seed) for x in languages], dtype="u8")
    hashes = span_hashes(lanes(data), start, length, seeds[language])
    piece = np.searchsorted(np.flatnonzero(letters == 10), start)
    follows = np.append(piece[1:] == piece[:-1], False)[: len(start)]
    return Words(data, start, length, hashes, follows, language, languages)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes).view("i8"))


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, n) for every word of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            words = words_of(batch, seed)
            _, first, group, n = np.unique(
                words.hashes, return_index=True, return_inverse=True, return_counts=True
            )
            # another word with the same hash is sent as well, so that it is noticed
            other = words.other_than(first[group])
            at = np.concatenate([first, other])
            yield pa.RecordBatch.from_arrays(
                [
                    words.languages_of(at),
                    pa.array([words.word(i) for i in at.tolist()], pa.string()),
                    _signed(words.hashes[at]),
                    pa.array(np.concatenate([n, np.zeros(len(other), "i8")])),
                ],
                names=["lang", "word", "h", "n"],
            )

    return (
        docs.mapInArrow(count, "lang string, word string, h long, n long")
        .groupBy("lang", "word", "h")
        .agg(F.sum("n").alias("n"))
    )


def bit_table(df: DataFrame, slot: Column) -> np.ndarray:
    """A table of ``2 ** TABLE_BITS`` bits in which the slots of ``df`` are set."""
    rows = (
        df.select((slot + 1).alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << TABLE_BITS) // 8, dtype="u1")
    for row in rows:
        at = (row["number"] - 1) * (BITMAP // 8)
        out[at : at + BITMAP // 8] = np.frombuffer(row["bits"], "u1")
    return out


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash's upper ``TABLE_BITS`` bits is set."""
    slot = hashes >> np.uint64(64 - TABLE_BITS)
    return table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype("u1") & 1 == 1


def _safe(words: Words, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first word, phrase hash) of all positions whose shorter phrases pass the tables: of words
    for pairs, of words and pairs for triples."""
    frequent = in_table(tables[0], words.hashes)
    joined = (words.follows & frequent)[:-1] & frequent[1:]
    pairs = words.pairs()
    if len(tables) == 1:
        at = np.flatnonzero(joined)
        return at, pairs[at]
    joined &= in_table(tables[1], pairs)
    at = np.flatnonzero(joined[:-1] & joined[1:])
    return at, words.triples()[at]


PACKED = "size int, shard int, phrases binary, n binary"


def _packed(
    size: int, shard: np.ndarray, phrases: np.ndarray, n: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its lines of ``phrases`` and their counts, ``CHUNK`` lines at a time.
    ``shard`` ascends."""

    def cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        values = np.ascontiguousarray(values)
        offsets = (bounds * values.strides[0]).astype("i4")
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values)]
        return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)

    for at in range(0, len(shard), CHUNK):
        own = slice(at, at + CHUNK)
        shards = shard[own].astype("i4")
        first = np.flatnonzero(np.diff(shards, prepend=-1))
        bounds = np.append(first, len(shards))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(first), size, "i4")),
                pa.array(shards[first]),
                cut(phrases[own], bounds),
                cut(n[own].astype("<u4"), bounds),
            ],
            names=["size", "shard", "phrases", "n"],
        )


def _unpacked(table: pa.Table, kind: str) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(size, shard, phrases, counts) of the rows of one size and shard."""
    size, shard = (table.column(c)[0].as_py() for c in ("size", "shard"))
    data, n = (b"".join(table.column(c).to_pylist()) for c in ("phrases", "n"))
    return size, shard, np.frombuffer(data, kind), np.frombuffer(n, "<u4")


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal ``keys`` begins, and the sum of its ``n``."""
    first = np.flatnonzero(np.append(len(keys) > 0, keys[1:] != keys[:-1])[: len(keys)])
    return first, np.add.reduceat(n, first, dtype="i8") if len(first) else first


def hot_buckets(
    docs: DataFrame, seed: int, tables, size: int, bits: int, least: int, shard_bits: int
) -> DataFrame:
    """(size, bucket): buckets whose phrases of ``size`` words occur ``least`` times together."""
    # bits of a bucket that its shard does not tell: fewer than 32, as there are at most 64 buckets
    # for each word of a shard
    low = bits - shard_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> Iterator[pa.RecordBatch]:
            bucket, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            offset = (bucket & np.uint64((1 << low) - 1)).astype("<u4")
            yield from _packed(size, bucket >> np.uint64(low), offset, n)

        for batch in gathered(batches):
            words = words_of(batch, seed)
            if len(words.start) < size:
                continue
            _, hashes = _safe(words, [t.value for t in tables[: size - 1]])
            held.append(hashes >> np.uint64(64 - bits))
            if sum(map(len, held)) >= CHUNK:
                yield from sent()
        if held:
            yield from sent()

    def hot(table: pa.Table) -> pa.Table:
        _, shard, offset, n = _unpacked(table, "<u4")
        order = np.argsort(offset)
        offset, n = offset[order], n[order]
        first, total = _sums(offset, n)
        bucket = (shard << low) + offset[first[total >= least]].astype("i8")
        return pa.table({"size": pa.array(np.full(len(bucket), size, "i4")), "bucket": bucket})

    packed = docs.mapInArrow(count, PACKED)
    return packed.groupBy("size", "shard").applyInArrow(hot, "size int, bucket long")


def listed(docs: DataFrame, seed: int, tables, shard_bits: int) -> DataFrame:
    """The phrases that pass ``tables``, by their words' hashes, with how often a task met each:
    packed by ranges of their hashes, ``1 << shard_bits`` of them."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {size: [] for size in range(2, MOST_WORDS + 1)}

        def sent() -> Iterator[pa.RecordBatch]:
            for size, pieces in held.items():
                if not pieces:
                    continue
                lines = np.concatenate(pieces)
                pieces.clear()
                hashes = _joined(*lines.T)
                order = np.argsort(hashes)
                lines = lines[order]
                # neighbours in hash order that are the same phrase
                first = np.flatnonzero(_differ(lines))
                n = np.diff(np.append(first, len(lines)))
                shard = hashes[order[first]] >> np.uint64(64 - shard_bits)
                yield from _packed(size, shard, lines[first], n)

        for batch in gathered(batches):
            words = words_of(batch, seed)
            for size, pieces in held.items():
                if len(words.start) < size:
                    continue
                at, hashes = _safe(words, [t.value for t in tables[: size - 1]])
                hit = in_table(tables[size - 1].value, hashes)
                at = at[hit]
                pieces.append(np.stack([words.hashes[at + i] for i in range(size)], axis=1))
            if sum(len(x) for pieces in held.values() for x in pieces) >= CHUNK:
                yield from sent()
        yield from sent()

    return docs.mapInArrow(found, PACKED)


def _differ(lines: np.ndarray) -> np.ndarray:
    """Whether each line differs from the one before; the first does."""
    out = np.ones(len(lines), dtype=bool)
    out[1:] = (lines[1:] != lines[:-1]).any(axis=1)
    return out


def counted_by_tries(packed: DataFrame, least: int, trie_phrases: int) -> DataFrame:
    """(size, h1, h2, h3, n): the phrases of ``listed`` that occur ``least`` times or more."""

    def count(table: pa.Table) -> pa.Table:
        size, _, words, n = _unpacked(table, "<u8")
        lines = words.reshape(-1, size)
        hashes = _joined(*lines.T)
        order = np.argsort(hashes)
        hashes, lines, n = hashes[order], lines[order], n[order]
        # phrases of one hash only add, so no frequent one is lost
        first, total = _sums(hashes, n)
        enough = np.repeat(total >= least, np.diff(np.append(first, len(hashes))))
        hashes, lines, n = hashes[enough], lines[enough], n[enough].astype("i8")
        new = _differ(lines)
        candidates = lines[new]
        if len(np.unique(hashes)) < len(candidates):  # different phrases of one hash
            candidates = np.unique(candidates, axis=0)
        weights = np.zeros(lines.shape, dtype="i8")
        weights[:, 0] = n
        follows = np.ones(lines.shape, dtype=bool)
        follows[:, -1] = False
        counts = np.zeros(len(candidates), dtype="i8")
        for at in range(0, len(candidates), trie_phrases):
            own = candidates[at : at + trie_phrases]
            trie = Trie.built(own, np.full(len(own), size))
            counts[at : at + trie_phrases] = trie.counts(
                lines.ravel(), follows.ravel(), size, weights.ravel()
            )
        kept = counts >= least
        out = np.zeros((MOST_WORDS, int(kept.sum())), dtype="u8")
        out[:size] = candidates[kept].T
        return pa.table(
            {
                "size": pa.array(np.full(out.shape[1], size, "i4")),
                **{f"h{i + 1}": _signed(h) for i, h in enumerate(out)},
                "n": counts[kept],
            }
        )

    return packed.groupBy("size", "shard").applyInArrow(
        count, "size int, h1 long, h2 long, h3 long, n long"
    )


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    block: int = BLOCK,
    trie_phrases: int = TRIE_PHRASES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(languages, words, phrases) of ``docs`` (lang, text): (lang, n), (lang, word, h, n) and
    (size, h1, h2, h3, n), words and phrases those with ``n >= least``. A word's hash tells its
    language as well."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    for seed in range(64):
        words = stored(count_words(docs, seed), "phrase-words")
        if words.groupBy("h").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("words of equal hash under every seed")
    languages = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-languages")
    total = languages.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(62, max(TABLE_BITS, (16 * total).bit_length()))
    words = words.where(F.col("n") >= least)
    shard_bits = max(1, (total // TASK_WORDS).bit_length())

    def upper(column: str, width: int) -> Column:
        """The upper bits of a number of ``width`` bits."""
        return F.shiftrightunsigned(F.col(column), width - TABLE_BITS)

    share = spark.sparkContext.broadcast
    tables = [share(bit_table(words, upper("h", 64)))]
    hot = 0
    for size in range(2, MOST_WORDS + 1):
        found = hot_buckets(docs, seed, tables, size, bits, least, shard_bits)
        buckets = stored(found, f"phrase-buckets-{size}")
        tables.append(share(bit_table(buckets, upper("bucket", bits))))
        hot += buckets.count()
    packed = listed(docs, seed, tables, max(shard_bits, (hot // block).bit_length()))
    counted = counted_by_tries(packed, least, trie_phrases)
    return languages, words, stored(counted, "phrase-counts")


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = {c: f"cast({c} as decimal(16,0))" for c in (a, left, right)}
    product = f"cast({SCALE} as decimal(7,0)) * ({wide[a]} * {wide[a]})"
    return F.expr(f"{product} div ({wide[left]} * {wide[right]})")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score, h1, h2, h3): every phrase by its worst cut."""

    def word(i: int) -> DataFrame:
        """Words as the ``i``-th of a phrase."""
        lang = [F.col("lang")] if i == 1 else []
        return words.select(
            *lang, F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"f{i}")
        )

    def pair(first: str, second: str, count: str) -> DataFrame:
        return phrases.where("size = 2").select(
            F.col("h1").alias(first), F.col("h2").alias(second), F.col("n").alias(count)
        )

    named = phrases.withColumnRenamed("n", "a").join(word(1), "h1").join(word(2), "h2")
    named = stored(named, "phrase-names")
    two = named.where("size = 2").select(
        "*", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"),
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
    )
    three = (
        named.where("size = 3")
        .join(word(3), "h3")
        .join(pair("h2", "h3", "f23"), ["h2", "h3"])
        .join(pair("h1", "h2", "f12"), ["h1", "h2"])
        .withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
    )
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "*",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
    )
    columns = ["lang", "phrase", "size", "a", "l", "r", "score", "h1", "h2", "h3"]
    return two.select(*columns).unionByName(three.select(*columns))


def without_parts(candidates: DataFrame, share: int = LONGER_SHARE) -> DataFrame:
    """``candidates`` without those that stand in a longer one with ``share`` per cent or more
    of their count."""
    inside = (
        candidates.where("size = 3")
        .select(F.explode(F.array(F.struct("h1", "h2"), F.struct(
            F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("p"), "a")
        .groupBy(F.col("p.h1").alias("h1"), F.col("p.h2").alias("h2"))
        .agg(F.max("a").alias("longer"))
    )
    pairs = candidates.where("size = 2").join(inside, ["h1", "h2"], "left")
    kept = pairs.where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    ).drop("longer")
    return kept.select(*candidates.columns).union(candidates.where("size = 3"))


def best_of_each(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """``candidates`` with ``rank``: each language's first ``top`` by score, count and phrase."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    within = Window.partitionBy("lang", "part").orderBy(*order)
    first = (
        candidates.withColumn("part", part)
        .withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= top)
        .drop("part", "rank")
    )
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(whole))
    return ranked.where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    top: int = TOP,
    block: int = BLOCK,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language of ``docs``
    (lang, text).

    Texts are lower-cased (A-Z) and cut into pieces at marks and line ends, pieces into words at
    blanks and tabs. A null text is empty, a null lang is ``und``; a language without a frequent
    phrase, and so an empty table, gives no rows. Equal rows count each; other columns are
    ignored. Ties in score and count follow the phrase's bytes.
    """
    languages, words, phrases = frequent_phrases(docs, least, block, trie_phrases)
    candidates = stored(scored(words, phrases), "phrase-scores")
    best = best_of_each(without_parts(candidates), top)
    return best.join(languages, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")],
    )

"""Token counts of whole texts by a word-level BPE, in two tiers and without a shuffle.

The tokenizer splits a text into pre-tokens and encodes each on its own, so the count of a text
is the sum of its pre-tokens' counts. Pre-tokens repeat. The frequent ones lie in a compact hash
table that is broadcast: open addressing over 16-byte keys, which are the pre-tokens themselves,
so an answer is never that of another pre-token. All others are encoded once per worker and
remembered there. Numpy finds the pre-tokens of a batch of texts and probes for all of them at
once.

That needs characters whose class and lower case one byte tells: Latin-1. Chunks between white
space that hold others, or what looks like a special token, go to the tokenizer as they are;
pre-tokens, normal forms and special tokens never reach across white space.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import utf8
from landfall.llm.spans import gathered, lane, lanes, mixed

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048

#: Documents, about, from which frequent pre-tokens are told, and how many of those the table
#: holds at most. They decide which tier answers, never the answer.
FREQUENT_DOCUMENTS = 4_000
FREQUENT_MOST = 65_536

#: Pre-tokens that a worker remembers: two generations of this size; the older is dropped whole.
GENERATION = 500_000

#: Bytes of a key of the table; longer pre-tokens are left to the workers.
LONGEST_KEY = 16

OTHER, LETTER, DIGIT, BLANK = range(4)


def _latin_tables() -> tuple[np.ndarray, bytes]:
    """The class of each Latin-1 character, and its lower case."""
    kinds = np.full(256, OTHER, dtype="u1")
    for code in range(256):
        if chr(code).isalpha():
            kinds[code] = LETTER
        elif chr(code).isnumeric():
            kinds[code] = DIGIT
    # fixed values: white space of the tokenizer's pattern
    kinds[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = BLANK
    lower = bytes(ord(chr(c).lower()) if chr(c).isalpha() else c for c in range(256))
    return kinds, lower


KINDS, LOWER = _latin_tables()

#: Endings that the tokenizer splits off with their apostrophe.
ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]

ASCII_BLANKS = re.compile("[\t-\r ]+")
SPECIAL = "<|"


def pre_tokens(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the pre-tokens of lower-case Latin-1 ``data``: runs of letters, single
    digits, runs of other characters; an apostrophe that begins such a run takes an ending."""
    kinds = KINDS[np.frombuffer(data, "u1")]
    first = np.ones(len(kinds), dtype=bool)
    first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    begun = np.append(first, True)
    marks = np.flatnonzero((np.frombuffer(data, "u1") == 39) & first)
    marks = marks[marks + 1 < len(kinds)]
    marks = marks[kinds[marks + 1] == LETTER]
    view = lanes(data)
    after = view[marks + 1]
    taken = np.zeros(len(marks), dtype="i8")
    for ending in ENDINGS:
        here = after & np.uint64((1 << (8 * len(ending))) - 1) == int.from_bytes(ending, "little")
        taken[here & (taken == 0)] = len(ending)
    marks, taken = marks[taken > 0], taken[taken > 0]
    begun[marks + 1] = False
    behind = marks + 1 + taken
    inner = behind < len(kinds)
    # a rest of letters becomes a pre-token of its own
    behind = behind[inner]
    begun[behind[kinds[behind] == LETTER]] = True
    start = np.flatnonzero(begun)
    length = np.diff(start)
    start = start[:-1]
    real = kinds[start] != BLANK
    return start[real], length[real]


@dataclass(frozen=True)
class HashTable:
    """Counts of short pre-tokens by open addressing with linear probing."""

    low: np.ndarray
    high: np.ndarray
    counts: np.ndarray
    most_probes: int

    @staticmethod
    def _home(low: np.ndarray, high: np.ndarray, mask: int) -> np.ndarray:
        return (mixed(low ^ mixed(high)) & np.uint64(mask)).astype("i8")

    @classmethod
    def built(cls, words: list[bytes], counts: list[int]) -> HashTable:
        """``words``: different, not empty, ``LONGEST_KEY`` bytes at most."""
        size = 1 << max(4, (2 * len(words) - 1).bit_length())
        low, high = (np.zeros(size, dtype="u8") for _ in range(2))
        held, probes = np.zeros(size, dtype="u2"), 1
        text = b"".join(words)
        length = np.fromiter(map(len, words), "i8", len(words))
        start = np.cumsum(length) - length
        view = lanes(text)
        a, b = (lane(view, start, length, n) for n in range(2))
        for i, at in enumerate(cls._home(a, b, size - 1).tolist()):
            tried = 1
            while held[at]:
                at, tried = (at + 1) & (size - 1), tried + 1
            low[at], high[at], held[at] = a[i], b[i], counts[i]
            probes = max(probes, tried)
        return cls(low, high, held, probes)

    def looked_up(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The count of each key, 0 if it is not held."""
        mask = len(self.counts) - 1
        at, out = self._home(low, high, mask), np.zeros(len(low), dtype="i8")
        open_ = np.arange(len(low))
        for _ in range(self.most_probes):
            here = at[open_]
            same = (self.low[here] == low[open_]) & (self.high[here] == high[open_])
            out[open_[same]] = self.counts[here[same]]
            # an empty place ends the search
            open_ = open_[~same & (self.counts[here] > 0)]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & mask
        return out


class _Remembered(dict):
    """Token counts of texts that the tokenizer was asked for, in two generations."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.old = Tokenizer.from_file(path), {}

    def __missing__(self, text: str | bytes) -> int:
        count = self.old.get(text)
        if count is None:
            whole = text.decode("latin-1") if isinstance(text, bytes) else text
            count = len(self.tokenizer.encode(whole, add_special_tokens=False).ids)
        if len(self) >= GENERATION:
            self.old = dict(self)
            self.clear()
        self[text] = count
        return count


_remembered: dict[str, _Remembered] = {}


def remembered(path: str) -> _Remembered:
    """One memory for each file and worker process."""
    if path not in _remembered:
        _remembered[path] = _Remembered(path)
    return _remembered[path]


def plain_part(text: str) -> tuple[bytes, list[str]]:
    """A text's Latin-1 chunks in lower case, and the chunks that the tokenizer must see."""
    if SPECIAL not in text:
        try:
            return text.encode("latin-1").translate(LOWER), []
        except UnicodeEncodeError:
            pass
    plain, odd = [], []
    for chunk in ASCII_BLANKS.split(text):
        try:
            plain.append(chunk.encode("latin-1"))
        except UnicodeEncodeError:
            odd.append(chunk)
            continue
        if SPECIAL in chunk:
            odd.append(chunk)
            plain.pop()
    return b" ".join(plain).translate(LOWER), odd


def counted(texts: list[str], table: HashTable, memory: dict) -> np.ndarray:
    """The token count of each text."""
    parts, odd = zip(*map(plain_part, texts)) if texts else ((), ())
    data = b" ".join(parts)
    start, length = pre_tokens(data)
    view = lanes(data)
    found = table.looked_up(*(lane(view, start, length, n) for n in range(2)))
    found[length > LONGEST_KEY] = 0
    missed = np.flatnonzero(found == 0)
    ends = (start + length)[missed].tolist()
    found[missed] = [memory[data[a:b]] for a, b in zip(start[missed].tolist(), ends)]
    bounds = np.cumsum([len(p) + 1 for p in parts])
    total = np.bincount(
        np.searchsorted(bounds, start, side="right"), weights=found, minlength=len(texts)
    ).astype("i8")
    for i, chunks in enumerate(odd):
        if chunks:
            total[i] += sum(map(memory.__getitem__, chunks))
    return total


def frequent_lengths(
    docs: DataFrame, path: str, documents: int = FREQUENT_DOCUMENTS, most: int = FREQUENT_MOST
) -> HashTable:
    """The token counts of the most frequent short pre-tokens of about ``documents`` texts."""
    every = max(1, docs.count() // max(1, documents))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            data = b" ".join(plain_part(t)[0] for t in batch.column("text").to_pylist())
            start, length = pre_tokens(data)
            ends = (start + length).tolist()
            words = [data[a:b] for a, b in zip(start.tolist(), ends) if b - a <= LONGEST_KEY]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], names=["word"])

    sampled = docs.select("text").where(
        F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    )
    rows = (
        sampled.mapInArrow(found, "word binary")
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(most)
        .collect()
    )
    memory = remembered(path)
    words = [bytes(r["word"]) for r in rows]
    counts = [memory[w] for w in words]
    held = [(w, c) for w, c in zip(words, counts) if 0 < c < 2**16]
    return HashTable.built([w for w, _ in held], [c for _, c in held])


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    A null text is empty; an empty one has no tokens. Special tokens written in a text count as
    one, as the tokenizer takes them. Rows are counted one by one, so ids may be null or repeat;
    other columns are ignored; an empty table gives no rows.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = remembered(path)
        for batch in gathered(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = counted(texts, table.value, memory)
            sizes = [len(utf8(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").combine_chunks(),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )

"""Alignment of the tokens that two tokenizers give for the same bytes.

Both token sequences cut the same bytes. Where a token of each ends at one byte lies a shared cut,
and the cuts divide the tokens into groups. They are found by divide and conquer: each interval of
tokens looks for a shared cut near its middle, by bisection of the other side's ends, and splits
there; an interval without one is a group. Numpy moves all open intervals of a batch of documents
one step at a time, so the recursion's calls are lines of arrays.

Tokens that end together are linked. The bytes of one are then a suffix of the other's, so the
different linked pairs are bounded by the two vocabularies (``most_pairs``), whatever the corpus:
their counts fit into a broadcast.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored, utf8
from landfall.llm.spans import gathered
from landfall.llm.tokens import BYTE_LETTERS, INVISIBLE, Encoder, as_ids

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Words whose ids a worker remembers: two generations of this size.
GENERATION = 400_000
LONGEST_KEPT = 64

#: Text bytes that are aligned together.
BATCH_BYTES = 2_000_000

#: Added to ids of the second tokenizer where those of both stand together.
OF_B = 1 << 31

SPACE_MARK = "▁"
END_MARKS = ".,;:!?"

#: The first tokenizer begins a new piece at a blank before a visible character, whose ids may
#: be had apart.
BEFORE_VISIBLE_KEPT = re.compile(rf"(?= [^\s{INVISIBLE}])")

#: A blank that both tokenizers do not simply keep with the word behind it.
NOT_SIMPLE = re.compile(rf" (?=[\s{INVISIBLE}]|\Z)")

#: A run of blanks belongs to what follows it, for the second tokenizer.
BEFORE_BLANKS = re.compile("(?<=[^ ])(?= )")


class _Odd(Exception):
    """The text needs a split of its own, or its bytes may not come back."""


class PlainEncoder(Encoder):
    """Ids of texts by the first tokenizer, special tokens' strings being plain text."""

    def __init__(self, path: str):
        super().__init__(path, 0)
        self.tokenizer.encode_special_tokens = True
        letters = {BYTE_LETTERS.get(byte, chr(byte)): byte for byte in range(256)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.pieces[number] = bytes(letters[c] for c in token)

    def ids(self, text: str) -> bytes:
        return self._ids(text) if text else b""


class PieceEncoder:
    """Ids of texts by the second tokenizer, which puts a blank before them; ``OF_B`` is added
    to each."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        if self.model.is_byte(number):
            return bytes([int(self.model.id_to_piece(number)[3:5], 16)])
        return self.model.id_to_piece(number).replace(SPACE_MARK, " ").encode()

    def ids(self, text: str) -> bytes:
        return array("I", [i + OF_B for i in self.model.encode(text)]).tobytes()

    def word(self, word: str) -> bytes:
        """The ids of ``word`` behind a blank, whose bytes must be those of the tokens."""
        # nothing is put before an empty text
        numbers = self.model.encode(word) if word else [self.model.piece_to_id(SPACE_MARK)]
        if b"".join(map(self.pieces.__getitem__, numbers)) != b" " + utf8(word):
            raise _Odd
        return array("I", [i + OF_B for i in numbers]).tobytes()


class Pair(dict):
    """Both tokenizers, and the ids of both for blank-led words, remembered in two generations:
    first those of the first tokenizer, then those of the second with ``OF_B`` added."""

    def __init__(self, path_a: str, path_b: str, generation: int = GENERATION):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = PlainEncoder(path_a), PieceEncoder(path_b)
        self.generation, self.old = generation, {}
        self.length_a, self.length_b = (
            np.array([len(p) for p in side.pieces], dtype="i8") for side in (self.a, self.b)
        )
        # marks that no token of b holds behind a letter stand by themselves there; those of a
        # never begin with a letter and go on with a mark
        joined = {
            mark for piece in self.b.pieces
            for letter, mark in pairwise(piece.decode(errors="replace")) if letter.isalpha()
        }
        self.marks = {}
        for mark in END_MARKS:
            number = self.b.model.piece_to_id(mark)
            if mark not in joined and self.b.pieces[number] == mark.encode():
                self.marks[mark] = self.a.ids(mark) + array("I", [number + OF_B]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word[-1:] in self.marks and word[:-1].isalpha():
                ids = self[word[:-1]] + self.marks[word[-1]]
            else:
                ids = self.a.ids(" " + word) + self.b.word(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.generation:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str | None) -> bytes | None:
        """The ids that the first tokenizer gives for a blank and ``text``, and the second for
        ``text``, mixed; None if there are none, or if the tokens' bytes are not those of the
        blank and the text."""
        if not text:
            return None
        try:
            if NOT_SIMPLE.search(" " + text):
                raise _Odd
            return b"".join(map(self.__getitem__, text.split(" ")))
        except _Odd:
            return self._whole(text)

    def _whole(self, text: str) -> bytes | None:
        a = b"".join(map(self.a.ids, BEFORE_VISIBLE_KEPT.split(" " + text)))
        try:
            b = b"".join(self.b.word(word[1:]) for word in BEFORE_BLANKS.split(" " + text))
        except _Odd:
            b = self.b.ids(text)
        whole = b" " + utf8(text)
        for side, ids in ((self.a, as_ids(a)), (self.b, as_ids(b) - np.uint32(OF_B))):
            if b"".join(map(side.pieces.__getitem__, ids.tolist())) != whole:
                return None
        return a + b


def separated(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the first and of the second tokenizer."""
    of_b = mixed >= OF_B
    return mixed[~of_b], mixed[of_b] - np.uint32(OF_B)


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """One pair for each two files and worker process, so that tasks share its memory."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def most_pairs(pair: Pair) -> int:
    """How many different pairs of tokens can end together: one is a suffix of the other."""
    total = 0
    for longer, shorter, equal in ((pair.a, pair.b, True), (pair.b, pair.a, False)):
        known: dict[bytes, int] = {}
        for piece in shorter.pieces:
            known[piece] = known.get(piece, 0) + 1
        for piece in longer.pieces:
            first = 0 if equal else 1
            total += sum(known.get(piece[i:], 0) for i in range(first, len(piece)))
    return total


def shared_cuts(
    ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of a, tokens of b) up to and with the end of every group, in order.

    ``ends_a`` and ``ends_b`` ascend; ``last_a`` and ``last_b`` tell, per document, the number of
    tokens up to and with its last.

    Of an interval with m inner ends of a, the middle one is looked up among the ends of b; if no
    token of b ends there, the next ones to the left and right in turn, until a cut is found or
    all m are tried. An interval with one token on either side has no inner cut.
    """
    a0, b0 = np.append(0, last_a[:-1]), np.append(0, last_b[:-1])
    a1, b1 = last_a, last_b
    tried = np.zeros(len(a0), dtype="i8")
    done_a, done_b = [], []
    while len(a0):
        inner = a1 - a0 - 1
        leaf = (tried >= inner) | (b1 - b0 == 1)
        done_a.append(a1[leaf])
        done_b.append(b1[leaf])
        a0, a1, b0, b1, tried, inner = (x[~leaf] for x in (a0, a1, b0, b1, tried, inner))
        aside = (tried + 1) // 2
        at = a0 + inner // 2 + np.where(tried % 2 == 1, -aside, aside)
        wanted = ends_a[at]
        there = np.searchsorted(ends_b, wanted)
        cut = ends_b[there] == wanted
        miss = ~cut
        at, there = at[cut] + 1, there[cut] + 1
        fresh = np.zeros(len(at), dtype="i8")
        a0, a1, b0, b1, tried = (
            np.concatenate(parts)
            for parts in (
                (a0[miss], a0[cut], at),
                (a1[miss], at, a1[cut]),
                (b0[miss], b0[cut], there),
                (b1[miss], there, b1[cut]),
                (tried[miss] + 1, fresh, fresh),
            )
        )
    cuts_a, cuts_b = np.concatenate([*done_a, a1]), np.concatenate([*done_b, b1])
    return np.sort(cuts_a), np.sort(cuts_b)


def _decimals(most: int) -> np.ndarray:
    """Each number's decimal digits in ASCII, zero bytes before them, with room for a mark."""
    width = len(str(most)) + 1
    out = np.zeros((most + 1, width), dtype="u1")
    numbers = np.arange(most + 1)
    for place in range(width - 1):
        digits = numbers // 10**place % 10 + ord("0")
        out[:, width - 2 - place] = np.where((numbers >= 10**place) | (place == 0), digits, 0)
    return out


DECIMALS = _decimals(2**16 - 1)


def written_groups(
    ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray
) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2,b3;`` and where each group ends in it."""
    sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    group_a = np.repeat(np.arange(len(cuts_a)), sizes_a)
    group_b = np.repeat(np.arange(len(cuts_b)), sizes_b)
    place_a = np.arange(len(ids_a)) + np.append(0, cuts_b[:-1])[group_a]
    place_b = np.arange(len(ids_b)) + cuts_a[group_b]
    lines = np.empty((len(ids_a) + len(ids_b), DECIMALS.shape[1]), dtype="u1")
    lines[place_a], lines[place_b] = DECIMALS[ids_a], DECIMALS[ids_b]
    lines[:, -1] = ord(",")
    lines[place_a[cuts_a - 1], -1] = ord("|")
    lines[place_b[cuts_b - 1], -1] = ord(";")
    kept = lines != 0
    ends = np.cumsum(kept.sum(axis=1))
    return lines[kept].tobytes(), ends[place_b[cuts_b - 1]]


def aligned(pair: Pair, texts: list[str | None]) -> list[tuple]:
    """Per text: n_a, n_b, groups' SHA-256 (empty without tokens), and the linked pairs as
    numbers ``a * 65536 + b``."""
    out: list[tuple] = [(0, 0, "", np.empty(0, dtype="<u4"))] * len(texts)
    found = [(i, ids) for i, ids in enumerate(map(pair.ids, texts)) if ids]
    if not found:
        return out
    mixed = as_ids(b"".join(ids for _, ids in found))
    ids_a, ids_b = separated(mixed)
    ends = np.cumsum([len(ids) // 4 for _, ids in found])
    last_a = np.cumsum(mixed < OF_B)[ends - 1]
    last_b = ends - last_a
    ends_a, ends_b = np.cumsum(pair.length_a[ids_a]), np.cumsum(pair.length_b[ids_b])
    cuts_a, cuts_b = shared_cuts(ends_a, ends_b, last_a, last_b)
    text, written = written_groups(ids_a, ids_b, cuts_a, cuts_b)
    links = (ids_a[cuts_a - 1] << np.uint32(16)) | ids_b[cuts_b - 1]
    groups = np.searchsorted(cuts_a, last_a) + 1
    n_a, n_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
    at = before = 0
    for (i, _), a, b, group in zip(found, n_a.tolist(), n_b.tolist(), groups.tolist()):
        end = int(written[group - 1])
        digest = hashlib.sha256(memoryview(text)[at : end - 1]).hexdigest()
        out[i] = a, b, digest, links[before:group]
        at, before = end, group
    return out


def align_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, groups_sha256, links (binary)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in gathered(batches, most=BATCH_BYTES):
            n_a, n_b, digests, links = zip(*aligned(pair, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").combine_chunks(),
                    pa.array(n_a, pa.int64()),
                    pa.array(n_b, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array([x.tobytes() for x in links], pa.binary()),
                ],
                names=["doc_id", "n_a", "n_b", "groups_sha256", "links"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        align, "doc_id long, n_a long, n_b long, groups_sha256 string, links binary"
    )


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype("i8")


def pair_counts(aligned_texts: DataFrame) -> DataFrame:
    """(a, b, n): how many links hold each pair of ids. Each task sends its sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0, dtype="<u4"), np.empty(0, dtype="i8"))]
        for batch in gathered(batches, "links"):
            links = b"".join(x.as_py() for x in batch.column("links"))
            held.append(np.unique(np.frombuffer(links, "<u4"), return_counts=True))
            if len(held) >= 16:
                held = [_merged(held)]
        codes, n = _merged(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array((codes >> 16).astype("i4")), pa.array((codes & 0xFFFF).astype("i4")),
             pa.array(n)],
            names=["a", "b", "n"],
        )

    return (
        aligned_texts.select("links")
        .mapInArrow(count, "a int, b int, n long")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    The first tokenizer gets a blank and the text, the second the text, before which it puts a
    blank itself. A text that is null or empty, or whose tokens' bytes differ from the blank and
    the text, has no tokens: zeros and an empty digest. ``n_best`` counts links whose pair is,
    over all rows, the most frequent of its second id, ties included; ``count_sum`` sums the
    pairs' counts. Equal rows count each; ids may be null or repeat; other columns are ignored;
    an empty table gives no rows.
    """
    import public_tokenizers

    path_a = path_a or public_tokenizers.path(FILE_A)
    path_b = path_b or public_tokenizers.path(FILE_B)
    texts = stored(align_texts(docs, path_a, path_b), "aligned-texts")
    rows = pair_counts(texts).toArrow()
    a, b, n = (rows.column(c).to_numpy() for c in ("a", "b", "n"))
    codes = a.astype("u4") << np.uint32(16) | b.astype("u4")
    order = np.argsort(codes)
    most = np.zeros(2**16, dtype="i8")
    np.maximum.at(most, b, n)
    table = docs.sparkSession.sparkContext.broadcast(
        (codes[order], n[order], (n == most[b])[order])
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = table.value
        for batch in gathered(batches, "links"):
            links = [np.frombuffer(x.as_py(), "<u4") for x in batch.column("links")]
            bounds = np.cumsum([0, *map(len, links)])
            at = np.searchsorted(known, np.concatenate(links))
            sums = np.append(0, np.cumsum(counts[at]))[bounds]
            bests = np.append(0, np.cumsum(best[at]))[bounds]
            n_links = pa.array(np.diff(bounds))
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).combine_chunks() for c in names[:3]],
                    n_links,  # within a group no ends but the last meet
                    n_links,
                    pa.array(np.diff(bests)),
                    pa.array(np.diff(sums)),
                    batch.column("groups_sha256").combine_chunks(),
                ],
                names=[*names, "groups_sha256"],
            )

    return texts.mapInArrow(
        weigh,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string",
    )

"""Files of token ids, compressed by an adaptive context-mixing range coder.

Ids are cut into blocks; every block begins with fresh contexts and has a checksum, so it can be
decoded by itself with its frame's index. Three predictions are mixed for each id:

- order 2: the id that last followed these two ids, order 1: the id that last followed this one,
  each with a confidence that grows when it comes true and falls when it does not;
- order 0: how often each id occurs in the frame, kept in the frame's index.

The two predicted ids get shares of the coding range that follow how often each came true in the
block at the same pair of confidences; the rest of the range is dealt out by order 0.

A block is a chain of dependent steps, but blocks do not depend on each other: numpy takes the
same step of many blocks at once. A frame is a run of whole documents, kept as one binary value
with its ids' index; frames are rows of a Parquet table, so that Spark commits, retries and
splits them as it does with any table, on any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import slices, stored
from landfall.llm.tokens import encoder, tokenizer_path

MAGIC = b"LFID"
VERSION = 2
HEADER = struct.Struct("<4sHHIIIQ")  # magic, version, block ids >> 8, documents, symbols, blocks, ids

BLOCK_IDS = 2_048
FRAME_IDS = 1 << 21

#: Blocks coded at once, or up to half as many more.
LANES = 4_096

#: Blocks turned at once from rows to columns.
TURNED = 64

#: Text bytes per written part, on average.
PART_BYTES = 32 << 20

#: Text bytes whose words are looked up together.
TEXT_BYTES = 24 << 20

#: Words that the tokenizing worker remembers, twice, beside the coder's tables: those that are not
#: letters and marks, and those of texts with odd blanks.
REMEMBERED = 150_000

#: Contexts of a block and order.
CONTEXTS = 1 << 9
CONTEXT_MASK = np.int32(CONTEXTS - 1)
#: Nothing seen yet in a context: no id is this guess, whatever the blocks coded beside it.
UNSEEN = -1 << 2

#: The shares of order 0 add up to at most 1 << MOST_BITS, so that the range, over 1 << 32 before
#: each id, lasts for them and for the shares of the guesses.
MOST_BITS = 20

#: Frames with larger ids are sorted to find their different ids.
DENSE_IDS = 1 << 20

#: Shares of the guesses of both orders, of 1 << 16, by confidence when a block begins.
FIRST_SHARES = np.array([520, 6_000, 16_000, 32_000], dtype="u8")
#: Shares of order 2 and order 1 in one number, the first in the upper half. Both lose their 32nd
#: part with each id and gain a step, the right one more: each stays over 1/128, the rest over 1/70.
SHARE_BITS, HALF, LOW_HALF = np.uint64(16), np.uint64(32), np.uint64((1 << 32) - 1)
LOSS_BITS, LOSS_MASK = np.uint64(5), np.uint64(0x7FF << 32 | 0x7FF)
GAIN0, GAIN1, GAIN2 = (np.uint64((16 + a) << 32 | 16 + b) for a, b in ((0, 0), (0, 1984), (1984, 0)))

NO_ID = np.iinfo("i8").min
NONE, LEAST, FULL = np.uint64(0), np.uint64(1 << 32), np.uint64((1 << 64) - 1)
COUNT_BITS, COUNT_MASK = np.uint64(MOST_BITS + 1), np.uint64((1 << (MOST_BITS + 1)) - 1)


class ChecksumError(ValueError):
    """A block's words do not end as written, or its ids do not have their checksum."""


def order0(counts: np.ndarray) -> np.ndarray:
    """Counts as shares of a power of two, each at least 1."""
    bits = min(MOST_BITS, (8 * len(counts) - 1).bit_length())
    if 2 * len(counts) > 1 << bits:
        raise ValueError(f"a frame holds at most {1 << (MOST_BITS - 1)} different ids")
    shares = 1 + counts.astype("i8") * ((1 << bits) - len(counts)) // counts.sum()
    shares[shares.argmax()] += (1 << bits) - shares.sum()
    return shares


class Tables:
    """Order 0 of many frames in a row: where each symbol's range begins, and how long it is.

    The symbols of a frame begin at ``base``, a multiple of ``CONTEXTS``, so that contexts do not
    depend on the other frames. After them stands one with the whole range, for guessed ids.
    """

    def __init__(self, shares: list[np.ndarray], owners: np.ndarray):
        bits = [int(s.sum()).bit_length() - 1 for s in shares]
        room = [-(-(len(s) + 1) // CONTEXTS) * CONTEXTS for s in shares]
        base = np.cumsum([0] + room[:-1])
        self.packed = np.zeros(sum(room), dtype="u8")
        for own, b, at in zip(shares, bits, base.tolist()):
            starts = np.append(np.cumsum(own) - own, 0).astype("u8")
            entries = starts << COUNT_BITS | np.append(own, 1 << b).astype("u8")
            self.packed[at : at + len(entries)] = entries
        self.shares, self.frame_base = shares, base
        self.base = base[owners].astype("i4")
        self.whole = (base + [len(s) for s in shares])[owners].astype("i4")
        self.bits = np.array(bits, dtype="u8")[owners]
        self.last_slot = (np.uint64(1) << self.bits) - np.uint64(1)
        self.kind = "u2" if max(room) <= 1 << 16 else "i4"
        self.slot_base = np.cumsum([0] + [1 << b for b in bits[:-1]])[owners]

    def slots(self) -> np.ndarray:
        """The symbol of each slot of each frame's range."""
        return np.concatenate(
            [
                np.repeat(np.arange(at, at + len(s), dtype="i4"), s)
                for s, at in zip(self.shares, self.frame_base.tolist())
            ]
        )


class Mixer:
    """Orders 1 and 2 of many blocks side by side; lanes stay in order of falling length."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype="i4")
        self.lane, self.lane_s = lane * np.int32(CONTEXTS), lane * np.int32(32)
        # guess and confidence in one number
        self.order1 = np.full(lanes * CONTEXTS, UNSEEN, dtype="i4")
        self.order2 = np.full(lanes * CONTEXTS, UNSEEN, dtype="i4")
        # by confidence in order 2, confidence in order 1, and whether both guess the same
        first = (FIRST_SHARES[:, None, None] << HALF) | FIRST_SHARES[None, :, None]
        first = np.repeat(first, 2, axis=2)
        first[:, :, 1] = (FIRST_SHARES[:, None] << HALF) | FIRST_SHARES[0]
        self.shares = np.tile(first.ravel(), lanes)
        self.at1 = self.at2 = self.lane.astype("i8")
        self.before = np.zeros(lanes, dtype="i4")

    def predict(self, live: int) -> None:
        """Looks up what the orders predict for the first ``live`` lanes."""
        if live < len(self.at1):
            self.at1, self.at2, self.before = self.at1[:live], self.at2[:live], self.before[:live]
            self.lane, self.lane_s = self.lane[:live], self.lane_s[:live]
        self.one, self.two = self.order1.take(self.at1), self.order2.take(self.at2)
        self.id1, self.id2 = self.one >> 2, self.two >> 2
        state = self.two & 3
        state <<= 2
        state += self.one & 3
        state <<= 1
        state += self.id1 == self.id2
        state += self.lane_s
        self.state = state.astype("i8")
        self.share = self.shares.take(self.state)

    def learn(self, ids: np.ndarray, right2: np.ndarray, given: np.ndarray) -> None:
        """Takes in ids; ``right2``: order 2 guessed them, ``given``: order 2 or 1 did."""
        share = self.share >> LOSS_BITS
        share &= LOSS_MASK
        np.subtract(self.share, share, out=share)
        share += np.where(right2, GAIN2, np.where(given, GAIN1, GAIN0))
        self.shares[self.state] = share
        # right: surer by one, up to 3; wrong: replaced
        fresh = ids << 2
        surest = fresh | 3
        fresh |= 1
        for table, at, entry, right in (
            (self.order1, self.at1, self.one, self.id1 == ids),
            (self.order2, self.at2, self.two, right2),
        ):
            entry += 1
            table[at] = np.where(right, np.minimum(entry, surest), fresh)
        at1 = ids & CONTEXT_MASK
        at1 += self.lane
        self.at1 = at1.astype("i8")
        at2 = ids * np.int32(30_011)
        at2 += self.before
        at2 &= CONTEXT_MASK
        at2 += self.lane
        self.at2 = at2.astype("i8")
        self.before = ids * np.int32(40_503)


def _in_order(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Blocks by falling length, their lengths, and how many go on at each step."""
    order = np.argsort(-np.array(lengths), kind="stable")
    sizes = np.array(lengths)[order]
    lives = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
    return order, sizes, lives.tolist()


def encode_blocks(
    blocks: list[np.ndarray], owners: list[int], shares: list[np.ndarray]
) -> list[np.ndarray]:
    """32-bit words of each block of symbols; ``owners``: the place of its frame in ``shares``."""
    order, _, lives = _in_order([len(b) for b in blocks])
    lanes, steps = len(blocks), len(lives)
    mixer, tables = Mixer(lanes), Tables(shares, np.array(owners)[order])
    data = np.empty((steps, lanes), dtype=tables.kind)
    for at in range(0, lanes, TURNED):
        rows = np.zeros((min(TURNED, lanes - at), steps), dtype=tables.kind)
        for row, i in zip(rows, order[at : at + TURNED]):
            row[: len(blocks[i])] = blocks[i]
        data[:, at : at + TURNED] = rows.T
    # never more than a word an id
    words = np.zeros(lanes * (steps + 2), dtype="u4")
    first = np.arange(lanes) * (steps + 2)
    at = first.copy()
    every_low, every_width = np.zeros(lanes, dtype="u8"), np.full(lanes, FULL, dtype="u8")

    for step in range(steps):
        live = lives[step]
        low, width = every_low[:live], every_width[:live]
        ids = data[step, :live] + tables.base[:live]
        mixer.predict(live)
        unit = width >> SHARE_BITS
        share = mixer.share
        part2 = share >> HALF
        part1 = share & LOW_HALF
        part2 *= unit
        part1 *= unit
        right2, right1 = mixer.id2 == ids, mixer.id1 == ids
        given = right2 | right1
        both = part2 + part1
        add = np.where(given, part2, both)
        add[right2] = NONE
        size = np.where(right2, part2, np.where(given, part1, width - both))
        packed = tables.packed.take(np.where(given, tables.whole[:live], ids))
        size >>= tables.bits[:live]
        add += size * (packed >> COUNT_BITS)
        packed &= COUNT_MASK
        np.multiply(size, packed, out=width)
        low += add
        over = low < add
        if over.any():
            _carry(words, at[:live][over] - 1)
        small = np.flatnonzero(width < LEAST)
        if len(small):
            ends, left = at[small], low[small]
            words[ends] = left >> HALF
            at[small] = ends + 1
            low[small] = left << HALF
            width[small] = width[small] << HALF
        mixer.learn(ids, right2, given)
    for shift in (HALF, NONE):
        words[at] = (every_low >> shift).astype("u4")
        at += 1
    out: list[np.ndarray] = [np.empty(0, "<u4")] * lanes
    for i, begin, end in zip(order.tolist(), first.tolist(), at.tolist()):
        out[i] = words[begin:end].astype("<u4")
    return out


def _carry(words: np.ndarray, at: np.ndarray) -> None:
    """Adds one to each of the words ``at``, and to the word before where that overflows."""
    while len(at):
        words[at] += np.uint32(1)
        at = at[words[at] == 0] - 1


def decode_blocks(
    coded: list[np.ndarray], lengths: list[int], owners: list[int], shares: list[np.ndarray]
) -> list[np.ndarray]:
    """The symbols of each block: the steps of ``encode_blocks`` taken back."""
    order, sizes, lives = _in_order(lengths)
    lanes, steps = len(coded), len(lives)
    mixer, tables = Mixer(lanes), Tables(shares, np.array(owners)[order])
    slots = tables.slots()
    words = np.concatenate([coded[i] for i in order] + [np.zeros(2, "<u4")])
    at = np.cumsum([0] + [len(coded[i]) for i in order[:-1]])
    every_rest = (words[at].astype("u8") << HALF) | words[at + 1]
    at += 2
    last = len(words) - 1
    every_width = np.full(lanes, FULL, dtype="u8")
    data = np.zeros((steps, lanes), dtype=tables.kind)

    for step in range(steps):
        live = lives[step]
        rest, width = every_rest[:live], every_width[:live]
        mixer.predict(live)
        unit = width >> SHARE_BITS
        share = mixer.share
        part2 = share >> HALF
        part1 = share & LOW_HALF
        part2 *= unit
        part1 *= unit
        both = part2 + part1
        right2, given = rest < part2, rest < both
        start = np.where(given, part2, both)
        start[right2] = NONE
        rest -= start
        size = np.where(right2, part2, np.where(given, part1, width - both))
        size >>= tables.bits[:live]
        # damaged data may point beyond the range
        slot = np.minimum(rest // size, tables.last_slot[:live]).view("i8")
        slot += tables.slot_base[:live]
        found = slots.take(slot)
        packed = tables.packed.take(np.where(given, tables.whole[:live], found))
        rest -= size * (packed >> COUNT_BITS)
        packed &= COUNT_MASK
        np.multiply(size, packed, out=width)
        small = np.flatnonzero(width < LEAST)
        if len(small):
            ends = at[small]
            # or ask for more words than there are
            rest[small] = (rest[small] << HALF) | words[np.minimum(ends, last)]
            at[small] = ends + 1
            width[small] = width[small] << HALF
        ids = np.where(given, np.where(right2, mixer.id2, mixer.id1), found)
        data[step, :live] = ids - tables.base[:live]
        mixer.learn(ids, right2, given)
    # the words end with the lower end of the range, which nothing is left of
    if every_rest.any():
        raise ChecksumError(f"{np.count_nonzero(every_rest)} blocks are damaged")
    out: list[np.ndarray] = [np.empty(0, data.dtype)] * lanes
    for at in range(0, lanes, TURNED):
        rows = np.ascontiguousarray(data[:, at : at + TURNED].T)
        for row, i, size in zip(rows, order[at : at + TURNED], sizes[at : at + TURNED]):
            out[i] = row[:size]
    return out


@dataclass
class Frame:
    """Whole documents: their ids in a row, and each one's id and number of ids."""

    doc_ids: list[int | None] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.parts.append(ids)
        self.size += len(ids)


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ids in order, how often each occurs, and the place of every id among them."""
    if int(ids.max()) >= DENSE_IDS:
        alphabet, coded, counts = np.unique(ids, return_inverse=True, return_counts=True)
        return alphabet, counts, coded.astype("i4")
    counts = np.bincount(ids)
    alphabet = np.flatnonzero(counts)
    places = np.zeros(len(counts), dtype="u2" if len(alphabet) <= 1 << 16 else "i4")
    places[alphabet] = np.arange(len(alphabet))
    return alphabet, counts[alphabet], places[ids]


def _at_once(blocks: int) -> list[slice]:
    """Blocks in equal runs of about ``LANES``, as few blocks take as many steps as many."""
    runs = max(1, round(blocks / LANES))
    ends = [blocks * i // runs for i in range(runs + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:]) if a < b]


def write_frames(frames: list[Frame]) -> list[bytes]:
    """The frames' bytes: header, packed index, and per block its words, length and checksum."""
    plans, blocks, owners, shares = [], [], [], []
    for number, frame in enumerate(frames):
        ids = np.concatenate(frame.parts)
        alphabet, counts, coded = _alphabet(ids)
        cut = [slice(i, i + BLOCK_IDS) for i in range(0, len(ids), BLOCK_IDS)]
        plans.append((alphabet, [zlib.crc32(ids[c].astype("<u4").tobytes()) for c in cut], len(ids)))
        blocks += [coded[c] for c in cut]
        owners += [number] * len(cut)
        shares.append(order0(counts))
    words = []
    for some in _at_once(len(blocks)):
        mine = owners[some]
        own = [o - mine[0] for o in mine]
        words += encode_blocks(blocks[some], own, shares[mine[0] : mine[-1] + 1])
    out = []
    for frame, (alphabet, sums, size), counted in zip(frames, plans, shares):
        own, words = words[: len(sums)], words[len(sums) :]
        numbers = np.array([NO_ID if d is None else d for d in frame.doc_ids], dtype="<i8")
        index = zlib.compress(
            numbers.tobytes()
            + np.array([len(p) for p in frame.parts], dtype="<u4").tobytes()
            + np.diff(alphabet, prepend=0).astype("<u4").tobytes()
            + counted.astype("<u4").tobytes()
        )
        table = np.array([[len(w), s] for w, s in zip(own, sums)], dtype="<u4").tobytes()
        head = HEADER.pack(
            MAGIC, VERSION, BLOCK_IDS >> 8, len(numbers), len(alphabet), len(own), size
        )
        out.append(
            b"".join([head, struct.pack("<I", len(index)), index, table, *(w.tobytes() for w in own)])
        )
    return out


def read_frames(payloads: list[bytes]) -> list[list[tuple[int | None, np.ndarray]]]:
    """(doc_id, ids) of the documents of each frame; a block that does not have its checksum
    raises ``ChecksumError``."""
    plans, coded, lengths, owners, shares = [], [], [], [], []
    for number, data in enumerate(payloads):
        magic, version, block, n_docs, n_symbols, n_blocks, n_ids = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("these bytes are no frame of this version")
        at = HEADER.size
        (size,) = struct.unpack_from("<I", data, at)
        index = zlib.decompress(data[at + 4 : at + 4 + size])
        at += 4 + size
        doc_ids = np.frombuffer(index, "<i8", n_docs)
        counts = np.frombuffer(index, "<u4", n_docs, 8 * n_docs)
        alphabet = np.cumsum(np.frombuffer(index, "<u4", n_symbols, 12 * n_docs), dtype="i8")
        shares.append(np.frombuffer(index, "<u4", n_symbols, 12 * n_docs + 4 * n_symbols))
        table = np.frombuffer(data, "<u4", 2 * n_blocks, at).reshape(-1, 2)
        at += 8 * n_blocks
        block <<= 8
        for b in range(n_blocks):
            coded.append(np.frombuffer(data, "<u4", table[b, 0], at))
            at += 4 * int(table[b, 0])
            lengths.append(min(block, n_ids - b * block))
        owners += [number] * n_blocks
        plans.append((doc_ids, counts, alphabet, table[:, 1]))
    decoded: list[np.ndarray] = []
    for some in _at_once(len(coded)):
        mine = owners[some]
        own = [o - mine[0] for o in mine]
        decoded += decode_blocks(coded[some], lengths[some], own, shares[mine[0] : mine[-1] + 1])
    out = []
    for doc_ids, counts, alphabet, sums in plans:
        own, decoded = decoded[: len(sums)], decoded[len(sums) :]
        known = alphabet.astype("<u4")
        # damaged data may give a guess that was never made
        parts = [known.take(b, mode="clip") for b in own]
        for number, (ids, checksum) in enumerate(zip(parts, sums)):
            if zlib.crc32(ids.tobytes()) != checksum:
                raise ChecksumError(f"block {number} is damaged")
        ids = np.concatenate(parts) if parts else np.empty(0, "<u4")
        documents = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
        out.append([(None if d == NO_ID else int(d), x) for d, x in zip(doc_ids, documents)])
    return out


def write(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Frames (part, frame, first, n_ids, payload) of all rows of ``docs`` by ascending id.

    Null texts are empty; equal ids stand by a hash of their texts, rows without id last. A
    document lies within one frame, however long. ``first`` counts the ids of the part's frames
    before. An empty table gives no frames.
    """
    path = tokenizer or tokenizer_path()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text").asc(), F.asc("text")]
    dealt = rows.repartitionByRange(max(1, -(-size // PART_BYTES)), *order[:2])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = encoder(path, REMEMBERED).documents
        part, written, first = TaskContext.get().partitionId(), 0, 0
        frames = [Frame()]

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal written, first
            done = [f for f in frames if f.size]
            for frame, payload in zip(done, write_frames(done) if done else []):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([written], pa.int32()),
                        pa.array([first], pa.int64()),
                        pa.array([frame.size], pa.int64()),
                        pa.array([payload], pa.binary()),
                    ],
                    names=["part", "frame", "first", "n_ids", "payload"],
                )
                written += 1
                first += frame.size

        for batch in batches:
            for piece in _by_bytes(batch):
                found = documents(piece.column(1))
                for doc_id, ids in zip(piece.column(0).to_pylist(), found):
                    if frames[-1].size >= FRAME_IDS:
                        if sum(f.size for f in frames) >= LANES * BLOCK_IDS:
                            yield from flush()
                            frames.clear()
                        frames.append(Frame())
                    frames[-1].add(doc_id, ids)
        yield from flush()

    return dealt.sortWithinPartitions(*order).mapInArrow(
        encode, "part int, frame int, first long, n_ids long, payload binary"
    )


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at least one row, and texts of about ``TEXT_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype="i8"), 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + TEXT_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def read_back(frames: DataFrame) -> DataFrame:
    """(part, frame, place, doc_id, offset, ids): the documents of stored frames, with each
    one's place within its frame and the ids before it in its part."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _together(batches):
            for (part, frame, first, _), documents in zip(rows, read_frames([r[3] for r in rows])):
                offsets = np.cumsum([first] + [len(x) for _, x in documents])[:-1]
                n = len(documents)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, "i4")),
                        pa.array(np.full(n, frame, "i4")),
                        pa.array(np.arange(n, dtype="i4")),
                        pa.array([d for d, _ in documents], pa.int64()),
                        pa.array(offsets.astype("i8")),
                        pa.array([x.tobytes() for _, x in documents], pa.binary()),
                    ],
                    names=["part", "frame", "place", "doc_id", "offset", "ids"],
                )

    return frames.select("part", "frame", "first", "payload").mapInArrow(
        decode, "part int, frame int, place int, doc_id long, offset long, ids binary"
    )


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in groups of about ``LANES`` blocks."""
    rows, most = [], max(1, LANES * BLOCK_IDS // FRAME_IDS)
    for batch in batches:
        for piece in slices(batch, most):
            for row in zip(*(c.to_pylist() for c in piece.columns)):
                rows.append(row)
                if len(rows) == most:
                    yield rows
                    rows = []
    if rows:
        yield rows


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """All rows of ``docs`` written as frames and read back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before: those of the part, known when its frames
    were written, and the parts' totals, one number each, added up on the driver.
    """
    spark = docs.sparkSession
    frames = stored(write(docs, tokenizer), "id-frames")
    totals = frames.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect()
    sums = np.cumsum([0] + [n for _, n in totals]).tolist()
    bases = spark.createDataFrame(
        [(part, base) for (part, _), base in zip(totals, sums)], "part int, base long"
    )
    return (
        read_back(frames)
        .join(F.broadcast(bases), "part")
        .select(
            "doc_id",
            (F.col("base") + F.col("offset")).alias("start"),
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        )
    )

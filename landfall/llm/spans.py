"""Words of many texts at once: byte spans in one buffer, with exact short keys and hashes.

The bytes of a batch of texts lie in one buffer. A view of it gives the eight bytes from any
position on as one number, so a word of up to eight bytes is one number, one of up to sixteen two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from landfall.llm.common import slices

#: Bytes of text that are worked on together, unless one text alone is longer.
BATCH_BYTES = 4_000_000

LANE = 8

#: The first n bytes of a lane.
LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(LANE + 1)], dtype="u8")


def lanes(data: bytes) -> np.ndarray:
    """For each position of ``data`` the eight bytes from there on; zeros follow the end."""
    return np.ndarray(len(data) + 1, "<u8", data + bytes(LANE), strides=(1,))


def lane(view: np.ndarray, start: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
    """Bytes ``8 * number`` to ``8 * number + 8`` of spans, zeros beyond their length."""
    at = np.minimum(start + LANE * number, len(view) - 1)
    return view[at] & LOW_BYTES[np.clip(length - LANE * number, 0, LANE)]


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(
    view: np.ndarray, start: np.ndarray, length: np.ndarray, seed: np.ndarray
) -> np.ndarray:
    """64-bit hashes of spans, each with a seed of its own. Spans of up to eight bytes with one
    length and seed never collide."""
    h = mixed(seed + length.astype("u8") * np.uint64(0x9E3779B97F4A7C15))
    live = np.flatnonzero(length > 0)
    number = 0
    while len(live):
        h[live] = mixed(h[live] ^ lane(view, start[live], length[live], number))
        number += 1
        live = live[length[live] > LANE * number]
    return h


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of true values."""
    framed = np.zeros(len(inside) + 2, dtype=bool)
    framed[1:-1] = inside
    edges = np.flatnonzero(framed[1:] != framed[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def gathered(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BATCH_BYTES
) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch):
            held.append(part)
            size += part.column(text).nbytes
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)

"""SimHash fingerprints, and all pairs of them within a Hamming distance, by vantage-point trees.

A tree splits fingerprints by their distance to a vantage point: near ones inside, the rest
outside. If two fingerprints differ by at most r, their distances to any vantage point differ by
at most r (triangle inequality), so a search follows both branches only near the boundary.

On 64 random bits all distances lie around 32, so few branches would be pruned with r = 4. The
trees therefore measure distance over a part of the bits. Such a distance obeys the triangle
inequality as well; and if the bits are cut into k parts, fingerprints that differ in at most d
bits differ in at most d // k bits of at least one part. One tree per part with that radius finds
every pair, and prunes far more.

The upper levels of each tree are grown from a sample and deal fingerprints out to shards. Each
fingerprint has a home shard and visits those whose boundary it overlaps; within a shard a lower
tree finds the pairs. Only the edges of a spanning forest leave a shard, so a group of copies
never becomes all its pairs. A shard that a crowd of near copies fills is cut into blocks, so no
task gets more than a fixed number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, slices, stored, words

#: Fingerprints in a shard on average; the number of shards follows the input.
SHARD_ROWS = 16_384

#: Rows of a shard, visitors included, that one task searches at most; a fuller shard is cut into
#: blocks of about half as many home rows and half as many rows that ask.
SHARD_MOST = 131_072

#: Sampled fingerprints per shard from which the upper tree is grown.
SAMPLE_PER_SHARD = 32

#: Levels of the upper tree at most; shards grow beyond it and are searched all the same.
MAX_LEVELS = 14

#: Rows and columns of a block of direct comparisons.
BLOCK = 256

XXH_SEED = 42
WORD_BITS = 64

BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little")


@dataclass(frozen=True)
class Fingerprints:
    """How texts become fingerprints and which of them link.

    ``shingle``: words of a shingle; ``longs``: 64-bit words of a fingerprint; ``parts``: parts
    of the bits that have a tree each; ``distance``: bits in which linked fingerprints may
    differ; ``radius``: search radius of each tree. Every pair is found if
    ``radius >= distance // parts``.
    """

    shingle: int = 4
    longs: int = 1
    parts: int = 3
    distance: int = 4
    radius: int = 1

    @property
    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(self.longs)]

    def masks(self) -> np.ndarray:
        """One line per part, of ``longs`` words: the bits that it measures."""
        bits = np.arange(self.longs * WORD_BITS)
        chosen = (bits * self.parts // len(bits))[None, :] == np.arange(self.parts)[:, None]
        return np.packbits(chosen, axis=1, bitorder="little").view("<u8")


#: The contract's fingerprint.
EXACT = Fingerprints()


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, space-joined; of all words if there are fewer."""
    if not tokens:
        return np.empty(0, dtype="u8")
    text = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), "i8", len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(tokens))
    digest, seed = xxhash.xxh64_intdigest, XXH_SEED
    bounds = zip(starts[: len(tokens) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(text[a:b], seed) for a, b in bounds), "u8", len(tokens) - size + 1)


def _remixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of each hash; word 0 is the hash itself."""
    if not word:
        return hashes
    mixed = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % 2**64)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def simhash(hashes: np.ndarray, longs: int = 1) -> list[int]:
    """A bit is 1 if it is set in over half the hashes; no hash: all bits 0."""
    out = []
    for word in range(longs):
        lanes = _remixed(hashes, word).view("u1").reshape(-1, 8)
        counts = [np.bincount(lanes[:, i], minlength=256) @ BIT_OF_BYTE for i in range(8)]
        bits = np.concatenate(counts) * 2 > len(hashes)
        out.append(int(np.packbits(bits, bitorder="little").view("<i8")[0]))
    return out


def fingerprints(docs: DataFrame, kind: Fingerprints = EXACT) -> DataFrame:
    """(doc_id, f0, f1, ...) for every row; null texts have no words, so all bits are 0."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = [
                    simhash(shingle_hashes(words(text), kind.shingle), kind.longs)
                    for text in part.column("text").to_pylist()
                ]
                columns = [pa.array(list(c), pa.int64()) for c in zip(*prints)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns], names=["doc_id", *kind.columns]
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in kind.columns)
    return docs.select("doc_id", "text").mapInArrow(hashed, schema)


def _distance(prints: np.ndarray, point: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Bits of ``mask`` in which ``prints`` and ``point`` differ; only the words that the mask
    has bits of are looked at."""
    total = None
    for word in np.flatnonzero(mask):
        bits = np.bitwise_count((prints[..., word] ^ point[..., word]) & mask[word])
        total = bits.astype("i4") if total is None else total + bits
    return total


@dataclass(frozen=True)
class UpperTree:
    """The upper levels of one part's tree: node i has the children 2i and 2i + 1."""

    levels: int
    points: np.ndarray
    bounds: np.ndarray
    mask: np.ndarray

    @classmethod
    def grown(cls, sample: np.ndarray, mask: np.ndarray, levels: int, seed: int) -> UpperTree:
        rng = np.random.default_rng(seed)
        points = np.zeros((2**levels, sample.shape[1]), dtype="u8")
        bounds = np.zeros(2**levels, dtype="i4")
        groups = {1: sample}
        for node in range(1, 2**levels):
            group = groups.pop(node)
            source = group if len(group) else sample
            points[node] = source[rng.integers(len(source))]
            distances = _distance(group, points[node], mask)
            bounds[node] = int(np.median(distances)) if len(group) else 0
            if 2 * node < 2**levels:
                inside = distances <= bounds[node]
                groups[2 * node], groups[2 * node + 1] = group[inside], group[~inside]
        return cls(levels, points, bounds, mask)

    def shards(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, ...]:
        """(row, shard, is home) of every shard that a row lives in or visits.

        Of two rows the one with the smaller home shard visits the other, so visits to smaller
        shards are left out: no pair is lost and half the copies are saved.
        """
        row = np.arange(len(prints))
        node = np.ones(len(prints), dtype="i8")
        home = np.ones(len(prints), dtype=bool)
        for _ in range(self.levels):
            distance = _distance(prints[row], self.points[node], self.mask)
            bound = self.bounds[node]
            inside = distance <= bound
            to_in, to_out = distance <= bound + radius, distance > bound - radius
            home_in, home_out = home & inside, home & ~inside
            # left of the home branch only what does not lead back to smaller shards
            to_in &= ~(home & ~inside)
            row = np.concatenate([row[to_in], row[to_out]])
            home = np.concatenate([home_in[to_in], home_out[to_out]])
            node = np.concatenate([2 * node[to_in], 2 * node[to_out] + 1])
        return row, node - 2**self.levels, home


class Forest:
    """Groups of numbered points; keeps the smallest number of each group."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def link_shard(
    prints: np.ndarray, home: np.ndarray, mask: np.ndarray, kind: Fingerprints, seed: int = 0
) -> np.ndarray:
    """Root of each row in the forest of the links between a home row and any other row within
    the radius of this part.

    A vantage-point tree over the home rows, descended by all rows at once. Only who belongs
    together matters, so rows that are joined already are not compared again: a crowd of copies
    costs little more than one of them.
    """
    forest, rng = Forest(len(prints)), np.random.default_rng(seed)
    every = np.full(prints.shape[1], 2**64 - 1, dtype="u8")
    stack = [(np.flatnonzero(home), np.arange(len(prints)), 0)]
    while stack:
        points, asking, depth = stack.pop()
        if not len(points):
            continue
        # rows that are in the points' group already would add nothing to it
        groups = forest.root[points]
        if (groups == groups[0]).all():
            asking = asking[forest.root[asking] != groups[0]]
        if not len(asking):
            continue
        inside = None
        if len(points) > BLOCK and depth < 64:
            vantage = prints[points[rng.integers(len(points))]]
            own = _distance(prints[points], vantage, mask)
            bound = int(np.median(own))
            inside = own <= bound
            if inside.all():
                bound -= 1
                inside = own <= bound
        if inside is None or not inside.any():
            for at in range(0, len(asking), BLOCK):
                rows = asking[at : at + BLOCK]
                for start in range(0, len(points), 8 * BLOCK):
                    columns = points[start : start + 8 * BLOCK]
                    groups = forest.root[columns]
                    if (forest.root[rows] == groups[0]).all() and (groups == groups[0]).all():
                        continue
                    part = _distance(prints[rows][:, None], prints[columns][None], mask)
                    a, b = np.nonzero(part <= kind.radius)
                    a, b = rows[a], columns[b]
                    near = _distance(prints[a], prints[b], every) <= kind.distance
                    forest.join(a[near], b[near])
            continue
        theirs = _distance(prints[asking], vantage, mask)
        stack.append((points[inside], asking[theirs <= bound + kind.radius], depth + 1))
        stack.append((points[~inside], asking[theirs > bound - kind.radius], depth + 1))
    return forest.root


def links(nodes: DataFrame, kind: Fingerprints = EXACT) -> DataFrame:
    """Edges (a, b), a > b, that join ``nodes`` (node, f0, ...) into the groups of linked
    fingerprints. ``nodes`` must be a stored table with one row per fingerprint."""
    spark = nodes.sparkSession
    count = nodes.count()
    levels = max(0, min(MAX_LEVELS, int(np.ceil(np.log2(max(1, count) / SHARD_ROWS)))))
    sample = (
        nodes.select(*kind.columns)
        .orderBy(F.xxhash64(*kind.columns), *kind.columns)
        .limit(SAMPLE_PER_SHARD << levels)
        .collect()
    )
    points = np.array([tuple(r) for r in sample], dtype="i8").reshape(-1, kind.longs).view("u8")
    trees = [
        UpperTree.grown(points, mask, levels, seed=i) for i, mask in enumerate(kind.masks())
    ]
    shared = spark.sparkContext.broadcast(trees)
    names = ["node", *kind.columns]

    def placed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints = _matrix(batch, kind)
        for number, tree in enumerate(shared.value):
            row, shard, home = tree.shards(prints, kind.radius)
            taken = pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names], names=names
            ).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), number, dtype="i4")),
                    pa.array(shard),
                    pa.array(home),
                    *taken.columns,
                ],
                names=["part", "shard", "home", *names],
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many rows each shard gets, per batch."""
        for batch in batches:
            for routed in placed(batch):
                shard, rows = np.unique(routed.column("shard").to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(shard), routed.column("part")[0].as_py(), "i4"))
                     if len(shard) else pa.array([], pa.int32()),
                     pa.array(shard), pa.array(rows)],
                    names=["part", "shard", "rows"],
                )

    full = (
        nodes.select(*names)
        .mapInArrow(fill, "part int, shard long, rows long")
        .groupBy("part", "shard")
        .agg(F.sum("rows").alias("rows"))
        .where(F.col("rows") > SHARD_MOST)
        .collect()
    )
    blocks = {(r["part"], r["shard"]): -(-2 * r["rows"] // SHARD_MOST) for r in full}
    cut = spark.sparkContext.broadcast(blocks)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for routed in placed(batch):
                yield from in_blocks(routed, cut.value)

    def link(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        order = np.argsort(node, kind="stable")
        number = table.column("part")[0].as_py()
        root = link_shard(
            _matrix(table, kind)[order],
            table.column("home").to_numpy()[order],
            shared.value[number].mask,
            kind,
        )
        node = node[order]
        joined = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": node[joined], "b": node[root[joined]]})

    routed = nodes.select(*names).mapInArrow(
        route,
        "block long, part int, shard long, home boolean, "
        + ", ".join(f"{n} long" for n in names),
    )
    return routed.groupBy("part", "shard", "block").applyInArrow(link, "a long, b long").distinct()


def in_blocks(routed: pa.RecordBatch, cut: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    """Rows (part, shard, home, ...) of one part with their block of the shard, 0 if it is whole.

    A shard cut into n has n times n blocks: block i * n + j is home to the rows of remainder i
    and is asked by those of remainder j, so every home row meets every row of the shard once.
    """

    def with_block(rows: pa.RecordBatch, block: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        others = [rows.column(c) for c in rows.schema.names if c not in ("part", "shard", "home")]
        return pa.RecordBatch.from_arrays(
            [pa.array(block), rows.column("part"), rows.column("shard"), pa.array(home), *others],
            names=["block", *rows.schema.names],
        )

    shard = routed.column("shard").to_numpy()
    home = routed.column("home").to_numpy(zero_copy_only=False)
    part = routed.column("part")[0].as_py() if len(shard) else 0
    whole = np.ones(len(shard), dtype=bool)
    for (of_part, number), n in cut.items():
        if of_part != part:
            continue
        here = np.flatnonzero(shard == number)
        whole[here] = False
        rows = routed.take(pa.array(here))
        own = _remixed(rows.column("node").to_numpy().view("u8"), 1) % np.uint64(n)
        own, lives = own.astype("i8"), home[here]
        for other in range(n):
            # as one that is asked, against the askers of remainder ``other``
            kept = np.flatnonzero(lives)
            yield with_block(
                rows.take(pa.array(kept)), own[kept] * n + other, np.ones(len(kept), dtype=bool)
            )
            # as one that asks the home rows of remainder ``other``; it is there already if it
            # is one of them
            kept = np.flatnonzero(~lives | (own != other))
            yield with_block(
                rows.take(pa.array(kept)), other * n + own[kept], np.zeros(len(kept), dtype=bool)
            )
    rest = np.flatnonzero(whole)
    yield with_block(routed.take(pa.array(rest)), np.zeros(len(rest), "i8"), home[rest])


def _matrix(batch: pa.RecordBatch | pa.Table, kind: Fingerprints) -> np.ndarray:
    columns = [batch.column(c).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch)
               else batch.column(c).to_numpy() for c in kind.columns]
    return np.ascontiguousarray(np.stack(columns, axis=1).astype("i8")).view("u8")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it reaches.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours to the smallest of them. Chains shorten by halves
    and more; every round is written to the shared folder.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(edges.distinct(), "component-edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.where("b > a")
            .join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("low").alias("b")))))
            .select("col.*")
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "component-edges")
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(seen) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(seen)


def groups(docs: DataFrame, kind: Fingerprints = EXACT) -> DataFrame:
    """Per row of ``docs``: doc_id, f0, ..., and component_id, the smallest doc_id of its group.

    Texts with equal fingerprints are always in one group; null and empty texts and those of
    blanks have fingerprint 0, linked like any other. Rows with one doc_id and different texts
    join their groups. Rows without doc_id have the group of their fingerprint (null if no row
    of it has an id). Other columns are ignored; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, kind), "fingerprints")
    nodes = stored(
        prints.groupBy(*kind.columns).agg(F.min("doc_id").alias("node")), "fingerprint-nodes"
    )
    known = nodes.where("node is not null")
    # rows with one doc_id and several fingerprints tie those together
    digest = F.xxhash64(*kind.columns)
    ties = (
        prints.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(digest).alias("p"), F.max(digest).alias("q"))
        .where("p <> q")
        .select("doc_id")
    )
    tied = (
        prints.join(ties, "doc_id")
        .join(known, kind.columns)
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    found = components(links(known, kind).union(tied))
    labelled = nodes.join(found, "node", "left").select(
        *kind.columns, F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(labelled, kind.columns)


def one_of_each(docs: DataFrame, kind: Fingerprints = EXACT) -> DataFrame:
    """``docs`` with one document of each group of linked fingerprints; all columns.

    The row with the smallest doc_id stays, one without id only if no row of its group has one;
    of several rows with that id the first in the stored input. Rows are told apart by their
    place there, so two texts under one id are two documents, linked by their fingerprints only.
    Null and empty texts have no words and are one group, as in ``groups``. An empty table gives
    no rows.
    """
    uid = fresh("lf_uid", docs.columns)
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered-documents")
    texts = rows.select(F.col(uid).alias("doc_id"), "text")
    of_row = groups(texts, kind).select(F.col("doc_id").alias(uid), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", uid))
    kept = stored(
        rows.select("doc_id", uid)
        .join(of_row, uid)
        .groupBy("component_id")
        .agg(first.alias("first"))
        .select(F.col(f"first.{uid}").alias(uid)),
        "kept-documents",
    )
    # most rows are kept, so both sides travel, at small sizes as at large ones
    return rows.join(kept.hint("merge"), uid, "left_semi").drop(uid)

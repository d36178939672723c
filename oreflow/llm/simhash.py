"""Near copies by SimHash: fingerprints compared exactly, tile by tile, where their bit counts allow a link."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from oreflow.llm.common import LOWER_BYTES, Workspace, salted_lookup
from oreflow.llm.components import components

SHINGLE_WORDS, SEED, RADIUS = 3, 42, 3
#: A fingerprint is cut into so many parts of 64 / PARTS bits, whose bit counts name its tile.
PARTS = 4
#: Fingerprints in a block of a tile, about; larger tiles have several blocks.
BLOCK = 4096
#: Shingles whose bits are spread out at once.
CHUNK = 200_000


def shingle_hashes(text: bytes | None, k: int = SHINGLE_WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of ``k`` words (A-Z as a-z, one space between words); repeats included.

    A text with fewer words is one shingle, one without words none.
    """
    words = (text or b"").translate(LOWER_BYTES).split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= k:
        return [xxh64_intdigest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - k + 1].tolist()
    return [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]


def fingerprints(hashes: list[list[int]]) -> np.ndarray:
    """For each list a 64-bit number whose bits are those set in over half of its hashes."""
    out = np.zeros(len(hashes), np.uint64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    votes = np.zeros((len(hashes), 64), np.int64)
    # A long list goes in several chunks; short ones share a chunk.
    flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(hashes)), sizes)
    for lo in range(0, len(flat), CHUNK):
        part, of = flat[lo : lo + CHUNK], owner[lo : lo + CHUNK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        votes[of[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    for bit in range(64):
        out |= (2 * votes[:, bit] > sizes).astype(np.uint64) << np.uint64(bit)
    return out


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
        lo = 0
        while lo < len(ids):
            found, total, hi = [], 0, lo
            while hi < len(ids) and (total < CHUNK or hi == lo):
                found.append(shingle_hashes(texts[hi].as_py()))
                total += len(found[-1])
                hi += 1
            prints = fingerprints(found)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(prints.view(np.int64))], names=["doc_id", "print"]
            )
            lo = hi


def tile_of(print_: str) -> list:
    """Bit counts of the parts of a fingerprint, lowest part first."""
    width = 64 // PARTS
    return [F.bit_count(F.shiftrightunsigned(print_, i * width).bitwiseAND(F.lit((1 << width) - 1))) for i in range(PARTS)]


def near_tiles(radius: int, parts: int = PARTS) -> list[tuple[int, ...]]:
    """Differences of bit counts that two fingerprints within ``radius`` bits can have; one of d and -d.

    Each differing bit moves the count of its part by one, so the differences of all parts add up
    to at most ``radius``.
    """
    out: list[tuple[int, ...]] = [()]
    for _ in range(parts):
        out = [(*d, x) for d in out for x in range(-radius, radius + 1) if sum(map(abs, d)) + abs(x) <= radius]
    return [d for d in out if d >= tuple([0] * parts)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block, packed: one row for each block, or several where it goes over batches."""
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(c)) for c in ("tile", "block")])
        heads = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(batch) else []
        ends = [*heads[1:], len(batch)]
        prints, nodes = (np.asarray(batch.column(c)) for c in ("print", "node"))
        pack = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary())
        at = pa.array(heads, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("tile").take(at), batch.column("block").take(at), pack(prints), pack(nodes)],
            names=["tile", "block", "prints", "nodes"],
        )


def linked_in(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and ``y`` of all pairs that differ in at most ``radius`` bits."""
    rows, cols = [], []
    step = max(1, 1_000_000 // max(len(y), 1))
    for lo in range(0, len(x), step):
        a, b = np.nonzero(np.bitwise_count(x[lo : lo + step, None] ^ y[None, :]) <= radius)
        rows.append(a + lo)
        cols.append(b)
    return np.concatenate(rows), np.concatenate(cols)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a graph by union-find: from each node but the smallest of its component to that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.fromiter((root(x) for x in range(len(nodes))), np.int64, len(nodes))
    child = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[roots[child]], nodes[child]


def _compared(radius: int):
    """Links between two blocks, at most one less than they have members: no pairs of a group go out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("prints", "nodes", "other_prints", "other_nodes")]
            for row in zip(*columns, strict=True):
                px, nx, py, ny = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, ("u8", "i8", "u8", "i8"), strict=True))
                a, b = linked_in(px, py, radius)
                a, b = nx[a], ny[b]
                apart = a != b
                if apart.any():
                    a, b = forest(a[apart], b[apart])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def print_links(points: DataFrame, work: Workspace, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that join all ``points`` (``print``, distinct; ``node``) within ``radius`` bits as they are joined.

    A tile is the points with the same bit counts in each part of the fingerprint; a large one is cut
    into blocks of about ``block`` by a hash.  A tile is compared with itself and with those whose
    counts differ by at most ``radius`` in all, bit by bit (exclusive or, bit counts); all other pairs of
    tiles are skipped, since their points are too far apart.  The work is quadratic in what a tile
    and its neighbours hold, about a twentieth of all pairs; a task holds two blocks.
    """
    base = 64 // PARTS + 2 * radius + 1
    # Digits from radius on, so that a neighbour below 0 takes nothing from the next digit.
    number = sum((c + radius) * F.lit(base**i) for i, c in enumerate(tile_of("print")))
    placed = points.select(number.cast("long").alias("tile"), "print", "node")
    sizes = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    # At most (64 / PARTS + 1) ** PARTS tiles, 83,521 rows of two numbers; and the blocks' numbers, a
    # number for every ``block`` points.
    sizes = work.keep(sizes, "tiles")
    dealt = placed.join(F.broadcast(sizes), "tile").withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")))
    spread = dealt.repartition("tile", "block").sortWithinPartitions("tile", "block")
    packed = spread.select("tile", "block", "print", "node").mapInArrow(
        _blocks, "tile long, block long, prints binary, nodes binary"
    )
    # A block that went over two batches is two rows; they are compared like two blocks.
    packed = work.keep(packed.withColumn("id", F.monotonically_increasing_id()), "blocks")
    shifts = [sum(x * base**i for i, x in enumerate(d)) for d in near_tiles(radius)]
    shift = F.explode(F.array(*[F.lit(s).cast("long") for s in shifts]))
    known = F.broadcast(sizes.select(F.col("tile").alias("near"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")))
    asks = packed.withColumn("shift", shift).withColumn("near", F.col("tile") + F.col("shift")).join(known, "near")
    asks = asks.where("shift <> 0 or block <= at").select("id", "near", "at", "shift", "block", "prints", "nodes")
    held = packed.select(
        F.col("tile").alias("near"),
        F.col("block").alias("at"),
        F.col("id").alias("other"),
        F.col("prints").alias("other_prints"),
        F.col("nodes").alias("other_nodes"),
    )
    # A key is one block, so a tile that holds a third of all points is still many keys.
    met = asks.join(held, ["near", "at"]).where("shift <> 0 or block < at or id <= other")
    met = met.select("prints", "nodes", "other_prints", "other_nodes")
    return met.mapInArrow(_compared(radius), "a long, b long")


def near_duplicates(docs: DataFrame, work: Workspace, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs`` (``doc_id``, ``text``).

    The fingerprint (16 hex digits) has the bits that are set in over half of the hashes of the text's
    shingles, repeats included; texts without words have 0 and are linked like any other.  Documents
    within ``radius`` bits are linked; the component is the smallest ``doc_id`` that links lead to.
    Documents with one fingerprint are one point from the start, whatever their number.

    Rows without ``doc_id`` are linked with nothing and have no component.  Rows of one ``doc_id`` are one
    document: its component joins what any of them is linked with.  Empty tables give no rows.
    """
    printed = work.keep(docs.select("doc_id", "text").mapInArrow(_fingerprinted, "doc_id long, print long"), "prints")
    known = printed.where("doc_id is not null")
    points = known.groupBy("print").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n"))
    points = work.keep(points, "points")
    first = work.keep(salted_lookup(known, points, "print").select("doc_id", "node").distinct(), "firsts")
    low = first.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_hi"), F.count(F.lit(1)).alias("n"))
    twice = salted_lookup(first, work.keep(low.where("a <> _hi"), "twice"), "doc_id").select("a", F.col("node").alias("b"))
    label = components(work.keep(twice.union(print_links(points, work, radius, block)), "links"), work)
    named = points.join(label.withColumnRenamed("component", "_c"), "node", "left")
    named = work.keep(named.select("print", "n", F.coalesce("_c", "node").alias("component")), "named")
    return salted_lookup(printed, named, "print", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )

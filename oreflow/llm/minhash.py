"""Near-duplicate documents by SuperMinHash signatures, bands, full verification and union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from oreflow.llm.common import LOWER_BYTES, WordHashes, Workspace, gram_hashes, mix, salted_lookup
from oreflow.llm.components import components

SHINGLE_WORDS = 5
#: A pair at 0.85 shares no band once in 2 million times: (1 - 0.85 ** 5) ** 25.
BANDS, ROWS = 25, 5
STEP = 0x9E3779B97F4A7C15
#: Shingles that are signed at once; bounds the table of permutations to this times BANDS * ROWS bytes.
CHUNK = 100_000


def shingle_set(text: bytes | None, hashes: WordHashes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; A-Z count as a-z."""
    return np.unique(gram_hashes(hashes.of((text or b"").translate(LOWER_BYTES).split()), k))


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``size`` for each non-empty set.

    Round i gives every element the i-th place of its own random permutation of the places, with
    value i + r; a place keeps its least value.  A set is done as soon as no later round can lower
    any place, which large sets are after two or three rounds.  Values of one round being spread
    over all places is what lowers the variance against independent minima.
    """
    out = np.full((len(sets), size), np.inf)
    x = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = None
    for i in range(size):
        draw = mix(x + np.uint64((i + 1) * STEP % 2**64))
        k = i + ((draw >> np.uint64(32)) * np.uint64(size - i) >> np.uint64(32)).astype(np.int64)
        r = i + (draw & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32
        if i == 0:
            place = k
        else:
            row = np.arange(len(x))
            place = places[row, k].astype(np.int64)
            places[row, k] = places[:, i]
        np.minimum.at(out.reshape(-1), owner * size + place, r)
        going = out.max(axis=1) >= i + 1
        stay = going[owner]
        if not stay.any():
            break
        if i == 0:
            first = k[stay]
            places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(first), 1))
            places[np.arange(len(first)), first] = 0
        elif not stay.all():
            places = places[stay]
        x, owner = x[stay], owner[stay]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rows):
        key = mix(key * np.uint64(STEP) + bits[:, :, i])
    return key.view(np.int64)


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            lo = 0
            while lo < len(ids):
                sets, total, hi = [], 0, lo
                while hi < len(ids) and (total < CHUNK or hi == lo):
                    sets.append(shingle_set(texts[hi].as_py(), hashes))
                    total += len(sets[-1])
                    hi += 1
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(super_minhash(full, bands * rows), bands, rows).tolist() if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "print", "keys"],
                )
                lo = hi

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lo in range(0, len(texts), 256):
            part = [shingle_set(t.as_py(), hashes).tobytes() for t in texts.slice(lo, 256)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, 256), pa.array(part, pa.large_binary()).cast(pa.binary())],
                names=["doc", "set"],
            )


def _differences(percent: int):
    """For a pivot and a member of its cell: are they linked, and which shingles has only one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                sizes, tops, linked, diffs = [], [], [], []
                for x, y in zip(part.column("set_doc"), part.column("set_pivot"), strict=True):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    only = np.setxor1d(x, y, assume_unique=True)
                    both = (len(x) + len(y) - len(only)) // 2
                    linked.append(100 * both >= percent * (len(x) + len(y) - both))
                    sizes.append(len(x))
                    tops.append(len(y))
                    diffs.append(only.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("pivot"),
                        part.column("doc"),
                        pa.array(sizes, pa.int64()),
                        pa.array(tops, pa.int64()),
                        pa.array(linked, pa.bool_()),
                        pa.array(diffs, pa.binary()),
                    ],
                    names=["pivot", "doc", "n", "pn", "linked", "diff"],
                )

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            found = [np.frombuffer(d.as_buffer(), np.int64) for d in part.column("diff")]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(rows) for c in ("pivot", "doc")), pa.array(np.concatenate(found))],
                names=["pivot", "doc", "e"],
            )


def _confirm(percent: int):
    """Pairs of one cell that are linked, by their sets' differences from the pivot.

    What x and y differ in is what their differences from the pivot differ in, so the sizes of both
    sets and of their intersection follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = ("nx", "ny", "diff_x", "diff_y")
            for n, m, x, y in zip(*(batch.column(c) for c in columns), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                apart = len(np.setxor1d(x, y, assume_unique=True))
                both = (n.as_py() + m.as_py() - apart) // 2
                good.append(100 * both >= percent * (both + apart))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("x", "y")], names=["a", "b"])

    return run


def _cell_links(cells: DataFrame, label: DataFrame, work: Workspace, percent: int) -> DataFrame:
    """Links between members of one cell that are not in one component yet.

    ``D`` of a member is what it and the pivot differ in.  Let c = (100 - percent) / (100 + percent): a
    pair is linked if its sets differ in at most c times the sum of their sizes.  Members linked with
    the pivot are in its component, so one of a pair looked for, x, is not: D(x) has more than
    c (|x| + |pivot|) elements, and a linked y shares more than (|D(y)| + c (|pivot| - |y|)) / 2 elements
    of its D with it.  Whatever the order of elements, one of those is then among the first
    |D(y)| - (that number) + 1 of D(y).  When x and y meet in an element, both sizes are known, and so
    is how many elements they must share; the first one they share must leave room for that behind it
    in either order, else the pair is passed over.  With the elements that are rare in the cell first,
    these are edits that few members share, so the members of a large group of copies meet in few
    pairs; and no pair is lost.
    """
    own = label.select(F.col("node").alias("doc"), "component")
    facts = cells.select("pivot", "doc", "n", "pn", "linked", (F.octet_length("diff") / 8).cast("long").alias("d"))
    facts = facts.join(own, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    facts = work.keep(facts, "members")
    mixed = facts.groupBy("pivot").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("n")
    )
    mixed = work.keep(mixed.where("_lo <> _hi").select("pivot", F.col("n").alias("_n")), "mixed")
    facts = salted_lookup(facts, mixed.withColumnRenamed("_n", "n"), "pivot")
    shared = (100 + percent) * F.col("d") + (100 - percent) * (F.col("pn") - F.col("n"))
    least = F.floor(shared / (2 * (100 + percent))).cast("long") + 1
    facts = work.keep(facts.withColumn("prefix", F.col("d") - least + 1), "facts")
    open_ = cells.join(facts.select("pivot", "doc").distinct(), ["pivot", "doc"])
    each = work.keep(open_.select("pivot", "doc", "diff").mapInArrow(_elements, "pivot long, doc long, e long"), "edits")
    # An element that one member has alone makes no pair; it only takes a place at the front.
    often = each.groupBy("pivot", "e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    marked = each.join(often, ["pivot", "e"]).join(facts, ["pivot", "doc"])
    member = Window.partitionBy("pivot", "doc")
    place = F.row_number().over(member.orderBy("often", "e")) + F.col("d") - F.count(F.lit(1)).over(member)
    marked = marked.withColumn("place", place).withColumn("room", F.col("d") - F.col("place") + 1)
    columns = ("doc", "n", "d", "room", "linked", "component")
    marked = work.keep(marked.select("pivot", "e", F.col("place") <= F.col("prefix"), *columns).toDF(
        "pivot", "e", "first", *columns
    ), "marked")
    index = marked.where("first").select("pivot", "e", *[F.col(c).alias(f"{c}_y") for c in columns])
    asks = marked.where("not linked").select("pivot", "e", "first", *[F.col(c).alias(f"{c}_x") for c in columns])
    apart = F.col("d_x") + F.col("d_y") - 2 * F.least("room_x", "room_y")
    meet = (
        (F.col("component_x") != F.col("component_y"))
        & (F.col("linked_y") | (F.col("first") & (F.col("doc_x") < F.col("doc_y"))))
        & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
        & ((100 + percent) * apart <= (100 - percent) * (F.col("n_x") + F.col("n_y")))
    )
    pairs = index.join(asks, ["pivot", "e"]).where(meet)
    pairs = pairs.select("pivot", F.col("doc_x").alias("x"), F.col("doc_y").alias("y")).distinct()
    for c in ("x", "y"):
        side = cells.select("pivot", F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("diff").alias(f"diff_{c}"))
        pairs = pairs.join(side, ["pivot", c])
    found = work.keep(pairs.mapInArrow(_confirm(percent), "a long, b long"), "links")
    work.drop(facts, each, marked)
    return found


def near_duplicates(
    docs: DataFrame, work: Workspace, percent: int = 85, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id``, ``text``).

    Two documents are linked if they share at least ``percent`` of their joint shingles.  Equal sets
    are one vertex from the start, whatever their number.  Of each bucket (documents with one band in
    common) the smallest ``doc_id`` is the pivot, and all buckets of a pivot are its cell.  First the
    members of a cell are compared with the pivot on their full sets; then those members of a cell
    that are not in one component yet with each other, if they share rare differences from the pivot
    (``_cell_links``).  So every pair that shares a band is checked, joined, or shown to be too far
    apart, no bucket is capped, and a large group of copies costs a few checks for each member.

    Rows without words, and rows without ``doc_id``, are linked with nothing; the latter have no
    component and are kept.  Rows of one ``doc_id`` are one document: its component joins what any of
    them is linked with.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    texts = docs.select("doc_id", "text")
    schema = "doc_id long, n_shingles long, print binary, keys array<long>"
    signed = work.keep(texts.mapInArrow(_sign(bands, rows), schema), "signed")
    known = signed.where("doc_id is not null and n_shingles > 0")
    each = F.count(F.lit(1)).alias("n")
    firsts = work.keep(known.groupBy("print").agg(F.min("doc_id").alias("first"), each), "firsts")
    met = salted_lookup(known.select("doc_id", "print", "keys"), firsts, "print")
    # The bands of a set are wanted once, from its first document.
    met = work.keep(met.withColumn("keys", F.when(F.col("doc_id") == F.col("first"), F.col("keys"))), "equal")
    linked = met.select("doc_id", "first").distinct()
    low = linked.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("_hi"), each)
    low = work.keep(low, "lowest")
    twice = salted_lookup(work.keep(linked, "linked"), low.where("a <> _hi"), "doc_id").select("a", F.col("first").alias("b"))
    heads = met.where("keys is not null").dropDuplicates(["doc_id", "print"])
    spread = work.keep(heads.select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc")), "spread")
    pivots = spread.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("_hi"), each)
    pivots = work.keep(pivots.where("pivot <> _hi").drop("_hi"), "pivots")
    pairs = salted_lookup(spread, pivots, "key").where("doc <> pivot").select("pivot", "doc").distinct()
    pairs = work.keep(pairs, "cells")
    wanted = pairs.select(F.col("doc").alias("doc_id")).union(pairs.select("pivot")).distinct()
    # Both sides grow with the table, so they meet by key at every size.
    chosen = texts.hint("merge").join(wanted, "doc_id")
    sets = work.keep(chosen.mapInArrow(_sets, "doc long, set binary"), "sets")
    tops = sets.select(F.col("doc").alias("pivot"), F.col("set").alias("set_pivot"))
    both = pairs.join(sets.withColumnRenamed("set", "set_doc"), "doc").join(tops, "pivot")
    schema = "pivot long, doc long, n long, pn long, linked boolean, diff binary"
    cells = work.keep(both.mapInArrow(_differences(percent), schema), "cells")
    work.drop(spread, pairs, sets)
    links = twice.union(cells.where("linked").select(F.col("pivot").alias("a"), F.col("doc").alias("b")))
    more = _cell_links(cells, components(links, work), work, percent)
    label = components(links.union(more), work)
    of_doc = low.select("doc_id", F.col("a").alias("first"), "n").join(
        label.select(F.col("node").alias("first"), "component"), "first", "left"
    )
    of_doc = work.keep(of_doc.select("doc_id", F.coalesce("component", "first").alias("component"), "n"), "labelled")
    named = salted_lookup(signed.select("doc_id", "n_shingles"), of_doc, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )

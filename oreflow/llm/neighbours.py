"""Approximate nearest neighbours by balanced posting lists and an in-memory graph of centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from oreflow.llm.common import Workspace

#: Bounds of what the driver fits on and every task holds: sampled vectors (at least, and for each list),
#: and centroids.
FIT_ROWS, FIT_PER_LIST, MAX_LISTS = 20_000, 16, 16_384
#: A vector goes to at most COPIES lists whose centroid is within 1 + COPY_RATIO of its nearest one.
COPIES, COPY_RATIO = 4, 0.1
#: A query reads all lists whose centroid is within 1 + PROBE_RATIO of its nearest one, and more where
#: fewer entries than LEAST_READ times the neighbours asked for live in them.
PROBE_RATIO, LEAST_READ = 0.13, 10
LINKS = 16
#: Vectors of one list that a task holds at once; queries that one copy of them answers.
CELL_ROWS, CELL_QUERIES = 4096, 65_536


@dataclass(frozen=True)
class Index:
    """Centroids (with one more coordinate, see ``lifted``) and the graph over them."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    top: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors on a sphere of radius ``top``: there the nearest is the one of largest inner product."""
        rest = np.maximum(self.top**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        scale = self.top / np.sqrt(np.einsum("ij,ij->i", queries, queries))
        return np.hstack([queries * scale[:, None], np.zeros((len(queries), 1))])

    def near(self, points: np.ndarray, ratio: float) -> np.ndarray:
        """Distances to the centroids within ``1 + ratio`` of the nearest; infinite for all others.

        Walks the graph: from the entries, the neighbours of every centroid within the ratio of the
        best one so far are looked at, until there is nothing new within it.
        """
        n, k = len(points), len(self.centroids)
        seen = np.full((n, k), np.inf)
        done = np.zeros((n, k), bool)
        seen[:, self.entries] = np.sqrt(
            ((points[:, None, :] - self.centroids[self.entries][None]) ** 2).sum(axis=2)
        )
        while True:
            open_ = ~done & (seen <= (1 + ratio) * seen.min(axis=1, keepdims=True))
            rows, nodes = np.nonzero(open_)
            if not len(rows):
                break
            done |= open_
            flat = np.unique((rows[:, None] * k + self.graph[nodes]).ravel())
            flat = flat[np.isinf(seen.ravel()[flat])]
            for lo in range(0, len(flat), 65_536):
                r, c = np.divmod(flat[lo : lo + 65_536], k)
                seen[r, c] = np.sqrt(((points[r] - self.centroids[c]) ** 2).sum(axis=1))
        seen[seen > (1 + ratio) * seen.min(axis=1, keepdims=True)] = np.inf
        return seen


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T


def fit_index(sample: np.ndarray, n_lists: int, top: float, rounds: int = 8) -> Index:
    """K-means with a price on large clusters, then links from each centroid to its nearest ones.

    The price of a cluster rises with its size in the last round, which keeps posting lists alike.
    """
    plain = Index(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int), top)
    points = plain.lifted(sample)
    n_lists = max(1, min(n_lists, len(points)))
    start = np.linspace(0, len(points) - 1, n_lists).astype(int)
    centres, price = points[start].copy(), np.zeros(n_lists)
    for _ in range(rounds):
        own = np.concatenate(
            [np.argmin(_squares(points[i : i + 2048], centres) + price, axis=1) for i in range(0, len(points), 2048)]
        )
        size = np.bincount(own, minlength=n_lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
        spread = ((points - centres[own]) ** 2).sum(axis=1).mean()
        price = price + 0.05 * spread * (np.minimum(size * n_lists / len(points), 3) - 1)
    links = min(LINKS, n_lists - 1)
    graph = np.zeros((n_lists, max(links, 1)), np.int64)
    for i in range(0, n_lists, 1024):
        apart = _squares(centres[i : i + 1024], centres)
        apart[np.arange(len(apart)), np.arange(i, i + len(apart))] = np.inf
        if links:
            graph[i : i + 1024] = np.argsort(apart, axis=1)[:, :links]
    # Far links, so that every centroid is reached from the entries however the data lie.
    graph = np.hstack([graph, (np.arange(n_lists)[:, None] + 1 + np.arange(2) * (n_lists // 2)) % n_lists])
    entries = np.unique(np.linspace(0, n_lists - 1, min(n_lists, 32)).astype(int))
    return Index(centres, graph, entries, top)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _spread(part: pa.RecordBatch, order: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Each row once for each of the first ``counts`` lists of its ``order``; ``nth`` counts them."""
    rows = np.repeat(np.arange(len(part)), counts)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    taken = part.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*taken.columns, pa.array(order[rows, nth], pa.int32()), pa.array(nth, pa.int32())],
        names=[*part.schema.names, "list", "nth"],
    )


def _post(index: Index):
    """The lists that each entry is put into, its nearest one first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                near = index.near(index.lifted(_matrix(part.column("vector"))), COPY_RATIO)
                order = np.argsort(near, axis=1, kind="stable")
                yield _spread(part, order, np.minimum(np.isfinite(near).sum(axis=1), COPIES))

    return run


def _ask(index: Index, ratio: float, homes: np.ndarray, least: int):
    """The lists that each query reads: all within the ratio, and on until ``least`` entries live there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                points = index.aimed(_matrix(part.column("vector")))
                near = index.near(points, ratio)
                inside = np.isfinite(near)
                few = np.flatnonzero(inside @ homes < least)
                near[few] = np.where(inside[few], near[few], np.sqrt(np.maximum(_squares(points[few], index.centroids), 0)) + near[inside].max(initial=0))
                order = np.argsort(near, axis=1, kind="stable")
                counts = inside.sum(axis=1)
                for i in few:
                    reach = np.searchsorted(np.cumsum(homes[order[i]]), least) + 1
                    counts[i] = min(max(counts[i], reach), len(homes))
                yield _spread(part, order, counts)

    return run


def _answer(k: int):
    """Vectors of a cell first, then its queries: each query gets the best ``k`` ids of the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, vectors, ids, owner = None, [], None, None, None
        for batch in batches:
            lists, kinds = (np.asarray(batch.column(c)) for c in ("cell", "kind"))
            cuts = np.flatnonzero((np.diff(lists) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if lists[lo] != cell:
                    cell, held, vectors = lists[lo], [], None
                if kinds[lo] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if vectors is None:
                    vectors = np.vstack([_matrix(p.column("vector")) for p in held])
                    groups = [p.column("ids") for p in held]
                    ids = np.concatenate([np.asarray(g.flatten()) for g in groups])
                    owner = np.repeat(np.arange(len(vectors)), np.concatenate([np.asarray(g.value_lengths()) for g in groups]))
                for at in range(0, len(part), 256):
                    asked = part.slice(at, 256)
                    yield _best(asked, vectors, ids, owner, k)

    return run


def _best(asked: pa.RecordBatch, vectors: np.ndarray, ids: np.ndarray, owner: np.ndarray, k: int) -> pa.RecordBatch:
    scores = _matrix(asked.column("vector")) @ vectors.T
    queries = np.asarray(asked.column("query_id"))
    reach = min(k + 1, len(vectors))
    found_ids, found_scores = [], []
    for query, row in zip(queries, scores, strict=True):
        # The k-th best of a cell's vectors bounds what can be among the best k; ties stay in.
        floor = np.partition(row, len(row) - reach)[len(row) - reach]
        keep = (row >= floor)[owner] & (ids != query)
        some, value = ids[keep], row[owner[keep]]
        order = np.lexsort((some, -value))[:k]
        found_ids.append(some[order])
        found_scores.append(value[order])
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found_ids])]).astype(np.int32)
    values = [np.concatenate(x) if x else np.zeros(0) for x in (found_ids, found_scores)]
    return pa.RecordBatch.from_arrays(
        [
            asked.column("query_id"),
            pa.ListArray.from_arrays(offsets, pa.array(values[0].astype(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(values[1].astype(np.float64))),
        ],
        names=["query_id", "ids", "scores"],
    )


def usable(vector: Column, dim: int | None = None) -> Column:
    """Not null, not zero, all components finite, and of ``dim`` components."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(real(x), F.lit(False)))
    good = good & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False)))
    return good if dim is None else good & (F.size(vector) == dim)


def nearest(
    vectors: DataFrame, work: Workspace, is_query: Column, k: int = 20, probe_ratio: float = PROBE_RATIO
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row where ``is_query`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``.  Nearness is the inner product in double precision of
    the original vectors; ties go to the smaller id.  All rows but the query's id are candidates.
    Vectors that are null, zero or not finite, of another length than most, or without id take no
    part.  Repeated rows count once.

    Equal vectors are one entry of the index with their ``k + 1`` smallest ids; the others can be
    among nobody's ``k`` nearest.  Vectors of 32-bit numbers travel as such and are widened where they are
    multiplied.  The index is fitted on about ``FIT_ROWS`` of the entries, or ``FIT_PER_LIST`` for each
    list if that is more, and then holds all: an entry goes to up to ``COPIES`` lists near its nearest centroid.  A query reads
    every list within ``probe_ratio`` of its nearest one, and the next ones while too few entries live
    in them.  Lists are cut into cells of ``CELL_ROWS``
    entries, and a cell that very many queries ask is copied, so neither side of a list is ever whole
    in one task; queries stream past the entries of a cell.
    """
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    typed = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    typed = typed.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("asks", is_query)
    sizes = typed.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], empty)
    dim, n = sizes[0]["dim"], sizes[0]["count"]
    typed = typed.where(F.size("vector") == dim)
    # Salted first: no task gathers more than some ten thousand ids, also where all vectors are equal.
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), F.col("vector")).alias("h2")]
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(1 + n // 65_536)).alias("salt")
    some = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    ids = typed.withColumn("ids", F.array("vec_id")).groupBy(*key, salt).agg(some).groupBy("h1", "h2").agg(some)
    shown = typed.select(*key, "vec_id", "vector")
    entries = ids.withColumn("vec_id", F.col("ids")[0]).join(shown, ["h1", "h2", "vec_id"])
    entries = work.keep(entries.dropDuplicates(["h1", "h2"]).select("ids", "vector"), "entries")
    norms = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    about = entries.agg(F.count(F.lit(1)).alias("n"), F.max(norms).alias("top")).first()
    n_lists = min(MAX_LISTS, max(1, round(about.n**0.5)))
    part = int(min(1.0, max(FIT_ROWS, FIT_PER_LIST * n_lists) / about.n) * (1 << 30)) + 1
    sample = entries.where(F.pmod(F.xxhash64("vector", F.lit(3)), F.lit(1 << 30)) < part)
    taken = sample.orderBy(F.col("ids")[0]).select("vector").toArrow().column("vector").combine_chunks()
    fit = _matrix(taken) if len(taken) else np.array([entries.first()["vector"]])
    index = fit_index(fit, n_lists, about.top * (1 + 1e-9))
    places = "list int, nth int"
    posted = entries.mapInArrow(_post(index), f"ids array<long>, vector array<{kind}>, {places}")
    posted = work.keep(posted, "lists")
    # How many entries live in each list, for at most MAX_LISTS lists.
    homes = np.zeros(len(index.centroids))
    for r in posted.where("nth = 0").groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        homes[r["list"]] = r["n"]
    asking = typed.where("asks").select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = asking.mapInArrow(
        _ask(index, probe_ratio, homes, LEAST_READ * (k + 1)), f"query_id long, vector array<{kind}>, {places}"
    )
    asked = work.keep(asked, "asked")
    # A row for each list, at most MAX_LISTS: how many cells and copies of them it needs.
    counts = posted.groupBy("list").agg(F.count(F.lit(1)).alias("rows"))
    wants = asked.groupBy("list").agg(F.count(F.lit(1)).alias("queries"))
    plan = counts.join(wants, "list").select(
        "list",
        F.ceil(F.col("rows") / CELL_ROWS).cast("int").alias("cells"),
        F.ceil(F.col("queries") / CELL_QUERIES).cast("int").alias("copies"),
    )
    cell = lambda block, copy: F.xxhash64("list", block, copy).alias("cell")
    block = F.pmod(F.xxhash64("vector"), F.col("cells")).cast("int")
    entry_rows = posted.join(plan, "list").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    entry_rows = entry_rows.select(
        cell(block, F.col("copy")), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "ids", "vector"
    )
    copy = F.pmod(F.xxhash64("query_id"), F.col("copies")).cast("int")
    query_rows = asked.join(plan, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    query_rows = query_rows.select(
        cell(F.col("block"), copy),
        F.lit(1).alias("kind"),
        "query_id",
        F.lit(None).cast("array<long>").alias("ids"),
        "vector",
    )
    dealt = entry_rows.unionByName(query_rows).repartition("cell").sortWithinPartitions("cell", "kind")
    answers = dealt.mapInArrow(_answer(k), "query_id long, ids array<long>, scores array<double>")
    single = answers.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("a")).select(
        "query_id", F.col("a.ids").alias("vec_id"), F.col("a.scores").alias("score")
    )
    single = single.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

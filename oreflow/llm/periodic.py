"""Periodic runs: stretches of words that repeat themselves, by uniting suffix classes from the longest match down."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from oreflow.llm.common import gram_hashes, mix

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of texts that are searched at once.
GROUP_WORDS = 200_000
REMEMBERED = 300_000
RUNS = "array<struct<start: long, length: long, period: long>>"


class Numbers(dict):
    """A number for each different word, from 0 in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def suffix_classes(words: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``least`` words come again in their text, in the order of suffixes; matches of neighbours.

    ``words`` are those of several texts, ``owner`` says of which; suffixes of different texts never
    match.  The second array holds how many words each suffix shares with the one before it (0 where
    that is below ``least``).  Windows are doubled: the class of a window is that of its halves.
    Positions alone in their class are left out from the start, so ordinary text costs one sort.
    """
    n = len(words)
    empty = np.zeros(0, np.int64)
    if n < least + 1:
        return empty, empty
    # Windows that hang over the end of a text hold its neighbour's number, so they are alone.
    grams = gram_hashes(mix(words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + owner.astype(np.uint64)), least)
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    at = at[owner[at] == owner[np.minimum(at + least - 1, n - 1)]]
    if not len(at):
        return empty, empty
    columns = [owner[at], *(words[at + i] for i in range(least))]
    classes = np.full(n + 1, -1, np.int64)

    def ranked(keys: list[np.ndarray]) -> np.ndarray:
        """The rank of each row of ``keys``, equal ones alike."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    # The next words of every position, two in a number, 0 behind the end of a text: they order windows
    # whose continuations differ within ``least`` words, as the classes do for longer ones.
    ahead = np.zeros(n + least + 1, np.int64)
    ahead[:n] = words + 1
    of = np.append(owner, np.full(least + 1, -1))
    next_ = lambda j, i: np.where(of[j + i] == of[j], ahead[j + i], 0)
    rank = ranked(columns)
    levels, width = [], least
    while True:
        classes[:] = -1
        classes[at] = rank
        levels.append((width, classes.copy()))
        if rank.max() + 1 == len(at):
            break
        # A window whose second half is alone in its text is alone: it gets a number of its own.
        there = np.minimum(at + width, n)
        further = classes[there]
        alone = further < 0
        further[alone] = -2 - at[alone]
        inside = of[there] == owner[at]
        pairs = [np.where(inside, next_(there, i) << 32 | next_(there, i + 1), 0) for i in range(0, least - 1, 2)]
        rank = ranked([rank, *pairs, further])
        width *= 2
    order = np.argsort(rank, kind="stable")
    at = at[order]
    match = np.zeros(len(at), np.int64)
    a, b = at[:-1].copy(), at[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for width, known in levels[::-1]:
        left, right = known[np.minimum(a, n)], known[np.minimum(b, n)]
        step = np.where((left >= 0) & (left == right), width, 0)
        shared += step
        a += step
        b += step
    # What is left is shorter than the smallest window.
    going = (shared >= least)
    for _ in range(least - 1):
        x, y = np.minimum(a, n - 1), np.minimum(b, n - 1)
        going &= (a < n) & (b < n) & (words[x] == words[y]) & (owner[x] == owner[at[:-1]]) & (owner[y] == owner[at[:-1]])
        shared += going
        a += going
        b += going
    match[1:] = np.where(shared >= least, shared, 0)
    return at, match


def runs_of(words: np.ndarray, owner: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """All runs in texts set one after the other, as ``start, length, period``, by start and period.

    Suffix classes are united in the order of falling matches (Kruskal's order on the suffix array), each
    class being the ordered set of its positions.  When two classes meet at a match of m words, positions
    that become neighbours in the united set and are at most m apart seed a run of their distance:
    the words from the first to m behind the second repeat at it.  It cannot repeat at less, since a
    position between them would have been in the class before.  A run of ``least_periods`` periods needs a
    match of one period less, so shorter matches are never looked at; a seed that could begin one word
    earlier is passed over, and so every run is found once, from its first word.
    """
    least = least_words - 1
    for p in range(1, least_words):
        least = min(least, max(least_words - p, (least_periods - 1) * p))
    at, match = suffix_classes(words, owner, max(least, 1))
    n, texts = len(words), owner
    order = np.argsort(-match, kind="stable")
    order = order[match[order] > 0]
    parent = list(range(len(at)))
    sets: list[list[int] | None] = [[p] for p in at.tolist()]
    runs = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seed(first: int, second: int, m: int) -> None:
        p = second - first
        if (least_periods - 1) * p > m or p + m < least_words:
            return
        if first and texts[first - 1] == texts[first] and words[first - 1] == words[second - 1]:
            return
        runs.append((first, p + m, p))

    for i, m in zip(order.tolist(), match[order].tolist(), strict=True):
        x, y = root(i - 1), root(i)
        small, large = sets[x], sets[y]
        if len(small) > len(large):
            x, y, small, large = y, x, large, small
        added = set(small) if len(small) > 1 else None
        for p in small:
            k = bisect_left(large, p)
            large.insert(k, p)
        for p in small:
            k = bisect_left(large, p)
            if k and not (added and large[k - 1] in added):
                seed(large[k - 1], p, m)
            if k + 1 < len(large) and not (added and large[k + 1] in added):
                seed(p, large[k + 1], m)
        parent[x], sets[x] = y, None
    return sorted(runs, key=lambda r: (r[0], r[2]))


def found_in(texts: list[bytes], numbers: Numbers) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text."""
    split = [t.split() for t in texts]
    if len(numbers) > REMEMBERED:
        numbers.clear()
    sizes = [len(w) for w in split]
    words = np.fromiter((numbers[w] for ws in split for w in ws), np.int64, sum(sizes))
    owner = np.repeat(np.arange(len(split)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out: list = [(w, []) for w in split]
    for start, length, period in runs_of(words, owner):
        text = int(owner[start])
        out[text][1].append((start - int(starts[text]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds behind its first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equal ones the first, then that of the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        ids, raw = batch.column("doc_id"), batch.column("text").cast(pa.binary())
        lo = 0
        while lo < len(ids):
            part, size = [], 0
            # About six bytes a word.
            while lo + len(part) < len(ids) and (not part or size < 6 * GROUP_WORDS):
                part.append(raw[lo + len(part)].as_py() or b"")
                size += len(part[-1])
            found = found_in(part, numbers)
            best = [strongest(r) for _, r in found]
            pick = lambda i: pa.array([b and b[i] for b in best], pa.int64())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, len(part)),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs in found], kind),
                    pick(0),
                    pick(1),
                    pick(2),
                    pa.array([collapsed(w, r) for w, r in found], pa.binary()),
                ],
                names=["doc_id", "runs", "start", "length", "period", "collapsed"],
            )
            lo += len(part)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, start, length, period, collapsed`` for each row of ``docs`` (``doc_id``, ``text``).

    A run is a stretch of words that are the same ``period`` words apart, ``period`` being the smallest such
    number, with at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods, which no neighbouring word
    extends.  ``runs`` has all of them by start and period; ``start``, ``length`` and ``period`` are those of the
    one with the most periods (ties: the first, then the smallest period), null without a run.
    ``collapsed`` is the text, as bytes, without what runs repeat, one space between words.

    Whole texts are searched row by row, without any exchange.  Null and empty texts have no run and
    collapse to nothing; rows that repeat come as often as they are; null ids stay null.
    """
    schema = f"doc_id long, runs {RUNS}, start long, length long, period long, collapsed binary"
    return docs.select("doc_id", "text").mapInArrow(_searched, schema)

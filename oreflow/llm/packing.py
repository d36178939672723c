"""Packing documents into sequences in which every window has the target mixture of sources."""

from __future__ import annotations

import sys
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import accumulate
from math import floor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from oreflow.llm.common import Workspace, buckets_for, hash_bucket, running_offsets

#: Documents that are tokenized at once, characters of them, and words that are remembered.
GROUP, GROUP_CHARS, REMEMBERED = 4096, 8_000_000, 600_000
LONG_WORD = 200
#: Marks that may follow a word.  None that is part of an added token or begins a contraction.
MARKS = ",.!?:;#$%&*)\""


# Fixed rule of byte-level tokenizers: bytes that are printable Latin-1 characters stand for themselves,
# the others, in order, for the characters from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _as_bytes(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)


class WordTokens:
    """Ids of texts by a tokenizer file, remembered word by word, as packed little-endian numbers.

    Only for tokenizers whose pre-tokenizer drops white space, so that the ids of a text are those
    of its words one after the other.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        probes = ("tokenization", "größe", "été", "слово")
        self.direct = all([t.id for t in self.tokenizer.model.tokenize(_as_bytes(w))] == ids(w) for w in probes)
        # Those that the tokenizer parts from a word before them.
        self.marks = "".join(c for c in MARKS if all(ids(w + 2 * c) == ids(w) + ids(2 * c) for w in (*probes, "x2", "½")))

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encodes many words: lower-case letters by the model alone, all others in one text.

        In a text each word gets its ids by the place they come from.  Words of letters only are one
        unit for a byte-level tokenizer, so there the steps before its model can be left out.
        """
        known, others = self.known, words
        if self.direct:
            others, tokenize, pack = [], self.tokenizer.model.tokenize, self._pack
            for w in words:
                if w.isalpha() and (w.islower() if w.isascii() else w == w.lower()):
                    known[w] = pack([t.id for t in tokenize(w if w.isascii() else _as_bytes(w))])
                else:
                    others.append(w)
        for lo in range(0, len(others), 4096):
            part = others[lo : lo + 4096]
            ends = np.cumsum([len(w) + 1 for w in part])
            code = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(code.ids, self.kind)
            owner = np.searchsorted(ends, np.array(code.offsets, np.int64).reshape(-1, 2)[:, 0], side="right")
            cuts = np.searchsorted(owner, np.arange(len(part) + 1))
            packed, (cuts, width) = ids.tobytes(), (cuts.tolist(), ids.itemsize)
            for i, w in enumerate(part):
                known[w] = packed[width * cuts[i] : width * cuts[i + 1]]

    @staticmethod
    def _spaced(text: str) -> str:
        # Lower case is the tokenizer's own first step; done here where it cannot make a difference.
        plain = text.isascii() or unicodedata.is_normalized("NFC", text)
        if plain and "<|" not in text and "İ" not in text and "Σ" not in text:
            text = text.lower()
        return text.replace("\n", " ")

    @staticmethod
    def _plain(word: str) -> bool:
        """Short, and as many characters after the tokenizer's normalization as before, so that places hold."""
        if len(word) > LONG_WORD:
            return False
        return word.isascii() or (len(word.lower()) == len(word) and unicodedata.is_normalized("NFC", word))

    def _recall(self, words: Iterable[str]) -> list[str]:
        """Takes words over from the older half; returns those that are new."""
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        for w in new:
            if w in older:
                known[w] = older[w]
        return [w for w in new if w not in known] if older else new

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Ids of each of different words."""
        if len(self.known) > REMEMBERED // 2:
            # Words that come again are taken over from the older half; the others go.
            self.known, self.older = {"": b""}, self.known
        known, marks = self.known, self.marks
        odd, ends, cores = [], [], []
        for w in self._recall(words):
            if w.isascii() and w.isalpha() and len(w) <= LONG_WORD:
                cores.append(w)
            elif not self._plain(w):
                odd.append(w)
            elif (core := w.rstrip(marks)) and core != w and core[-1].isalnum():
                ends.append((w, core, w[len(core) :]))
                cores += ends[-1][1:]
            else:
                cores.append(w)
        self._learn(self._recall(set(cores)))
        # Not remembered: words with marks, and long and unusual ones, which are encoded alone.
        passing = {w: known[core] + known[tail] for w, core, tail in ends}
        passing |= {w: self._pack(self.tokenizer.encode(w, add_special_tokens=False).ids) for w in odd}
        return [known[w] if w in known else passing[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encoded(texts).to_pylist()

    def encoded(self, texts: list[str]) -> pa.Array:
        """Each word of the texts is looked up once, and put in its places by Arrow."""
        words = pc.split_pattern(pa.array(map(self._spaced, texts), pa.string()), " ")
        coded = words.flatten().dictionary_encode()
        ids = pa.array(self._lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
        return pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids.take(coded.indices)), b"")


@lru_cache(maxsize=1)
def _coder(path: str, job: str) -> WordTokens:
    """One for all tasks of a job that a Python process runs, as half the words of a task come in others too."""
    return WordTokens(path)


def _tokenize(path: str, end_id: int, job: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, job)
        end = pa.scalar(np.array([end_id], coder.kind).tobytes())
        width = np.dtype(coder.kind).itemsize
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            # Bytes that are not UTF-8 count as replacement characters.
            texts = batch.column("text").cast(pa.binary())
            lo = 0
            while lo < len(texts):
                part, size = [], 0
                while lo + len(part) < len(texts) and len(part) < GROUP and size < GROUP_CHARS:
                    part.append((texts[lo + len(part)].as_py() or b"").decode("utf-8", "replace"))
                    size += len(part[-1])
                ids = pc.binary_join_element_wise(coder.encoded(part), end, b"")
                others = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + len(part)), pa.int64()),
                        *(batch.column(c).slice(lo, len(part)) for c in others),
                        pc.divide(pc.binary_length(ids), width).cast(pa.int64()),
                        ids,
                    ],
                    names=["row", *others, "doc_tokens", "ids"],
                )
                row += len(part)
                lo += len(part)

    return run


class Shares:
    """How many tokens of each queue the sequences hold up to a place in all tokens.

    ``F(k, g)`` is what the queues up to the k-th, in order, have sent when ``g`` tokens are out; it grows
    in straight lines, with a bend where a queue ends.  The k-th queue has then sent ``floor(F(k, g))
    - floor(F(k - 1, g))`` tokens: all queues together exactly ``g``, and each less than one token
    more or less than its share, so what rounding leaves open is carried on from window to window.
    From one window to the next this never falls for a queue whose share of a window is a token or more.
    """

    def __init__(self, total: int, bends: list[tuple[int, list[Fraction]]] | None = None):
        # ``bends``: places in all tokens, and F there for k = 0, 1, ...; without them F is one line.
        self.total, self.bends = total, bends
        self.at = [g for g, _ in bends] if bends else []

    def line(self, k: int, whole: int, g: int) -> int:
        """``floor(F(k, g))``; ``whole`` is how many tokens the sources up to the k-th have."""
        if self.bends is None:
            return whole * g // self.total
        i = min(max(bisect_right(self.at, g), 1), len(self.at) - 1)
        (g0, f0), (g1, f1) = self.bends[i - 1], self.bends[i]
        return floor(f0[k] + (f1[k] - f0[k]) * Fraction(g - g0, g1 - g0)) if g1 > g0 else floor(f1[k])


def bends_of(queues: list[tuple[int, float]]) -> list[tuple[Fraction, list[Fraction]]]:
    """Where the lines bend for queues of (tokens, weight), in order: a place for each end of a queue.

    Queues with a weight send in proportion to it until they are empty; those without come
    after them, in proportion to their tokens.
    """
    left = [Fraction(n) for n, _ in queues]
    weights = [Fraction(w) for _, w in queues]
    sent = [Fraction(0)] * len(queues)
    out = [(Fraction(0), [Fraction(0)] * (len(queues) + 1))]
    while any(left):
        rates = [w if n else Fraction(0) for n, w in zip(left, weights, strict=True)]
        if not any(rates):
            rates = list(left)
        step = min(n / r for n, r in zip(left, rates, strict=True) if r)
        moved = [r * step for r in rates]
        left = [n - m for n, m in zip(left, moved, strict=True)]
        sent = [a + m for a, m in zip(sent, moved, strict=True)]
        out.append((sum(sent), [Fraction(0), *accumulate(sent)]))
    return out


def pieces_of(shares: Shares, k: int, below: int, upto: int, begin: int, n: int, window: int) -> list[tuple[int, int, int, int]]:
    """``start, length, sequence, offset`` of a document of ``n`` tokens that begins at ``begin`` in the k-th queue.

    The queues before it have ``below`` tokens, those up to it ``upto``; its share of a window is a token or more.
    """
    total = shares.total

    def sent(w: int) -> tuple[int, int]:
        g = min(w * window, total)
        low = shares.line(k - 1, below, g)
        return shares.line(k, upto, g) - low, low

    def window_of(x: int) -> int:
        """The window that the queue's token ``x`` goes to: the last one before which it was not sent."""
        lo, hi = 0, -(-total // window) - 1
        if shares.bends is None:
            # One line: the window is known but for rounding.
            own = (upto - below) * window
            guess, spread = x * total // own, 2 + total // own
            lo, hi = max(lo, guess - spread), min(hi, guess + spread)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if sent(mid)[0] <= x else (lo, mid - 1)
        return lo

    out, at, w = [], 0, window_of(begin)
    own, low = sent(w)
    straight = shares.bends is None
    while at < n:
        if straight:
            g = min((w + 1) * window, total)
            low_after = below * g // total
            own_after = upto * g // total - low_after
        else:
            own_after, low_after = sent(w + 1)
        length = own_after - begin - at
        if length > n - at:
            length = n - at
        if length > 0:
            out.append((at, length, w, low_after - low + begin + at - own))
            at += length
            own, low, w = own_after, low_after, w + 1
        else:
            # Nothing of the queue is in this window, as before its turn has come.
            w = window_of(begin + at)
            own, low = sent(w)
    return out


def lanes_of(queues: DataFrame, n_tokens: int, weights: dict[str | None, float] | None, window: int) -> DataFrame:
    """``source, lane, weight, tokens``: which queue the documents of a source stand in, a row a source.

    A source that a window holds a token of, or more, has a lane of its own.  Rarer ones share a lane,
    and if that is too rare itself, it joins the rarest of the others; those without a weight share one too.
    """
    # Names above those of lanes of their own.
    rare, unweighted = 1 << 40, (1 << 40) + 1
    given = F.col("tokens").cast("double")
    if weights is not None:
        given = F.lit(0.0)
        for source, weight in weights.items():
            given = F.when(F.col("source").eqNullSafe(F.lit(source)), float(weight)).otherwise(given)
    named = queues.select("source", "tokens", given.alias("weight"))
    whole = named.agg(F.sum("weight")).first()[0] if weights is not None else n_tokens
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    lane = F.when(F.col("weight") == 0, unweighted).when(F.col("weight") * window < F.lit(whole), rare).otherwise(turn)
    laned = named.withColumn("lane", lane)
    sums = laned.where(F.col("weight") > 0).groupBy((F.col("lane") == rare).alias("rare")).agg(
        F.sum("weight").alias("weight"), F.min_by("lane", F.struct("weight", "lane")).alias("least")
    )
    found = {r.rare: r for r in sums.collect()}
    if True in found and False in found and found[True].weight * window < whole:
        laned = laned.withColumn("lane", F.when(F.col("lane") == rare, found[False].least).otherwise(F.col("lane")))
    return laned


def _cut(window: int, shares: Shares):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            sources: list[int] = []
            names = ("doc_id", "doc_tokens", "queued", "k", "below", "upto")
            rows = zip(*(batch.column(c).to_pylist() for c in names), batch.column("ids"), strict=True)
            crc = zlib.crc32
            for i, (doc, n, begin, k, below, upto, ids) in enumerate(rows):
                raw = ids.as_buffer()
                wide = memoryview(np.frombuffer(raw, f"<u{raw.size // n}").astype("<u4")).cast("B")
                cuts = pieces_of(shares, k, below, upto, begin, n, window)
                starts, lengths, sequences, offsets = zip(*cuts, strict=True)
                out[0] += [doc] * len(cuts)
                out[1] += starts
                out[2] += lengths
                out[3] += [crc(wide[4 * a : 4 * (a + b)]) for a, b, _, _ in cuts]
                out[4] += [n] * len(cuts)
                out[5] += sequences
                out[6] += offsets
                sources += [i] * len(cuts)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out), batch.column("source").take(pa.array(sources, pa.int64()))],
                names=[*PIECES, "source"],
            )

    return run


PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    work: Workspace,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    weights: dict[str | None, float] | None = None,
    place: str | None = None,
) -> DataFrame:
    """Pieces of all ``docs`` (``doc_id``, ``source``, ``text``) in sequences of ``window`` tokens.

    Deficit round-robin: in every window a source gains its share of ``window`` tokens as credit
    (``weights``, or its share of all tokens) and sends as many tokens from the head of its queue,
    documents being cut where the credit ends; what is less than a token is carried on.  Up to the end
    of any window each source has so sent its share of all tokens to within one.  How much it has sent is
    known in closed form (``Shares``), so from its place in its queue alone a document knows its
    windows and its places there: deficits pass from window to window and from one partition to the
    next without any task seeing a queue or a window.  In a window sources follow each other in order;
    only the last window is shorter.

    Sources whose share of a window is less than a token stand in one queue (``lanes_of``), where documents
    follow each other by how far they are through their source, and are cut as those of one source.
    With ``weights`` a queue that ends leaves its share to the others, by their weights; sources
    without a weight come after the others.  Rows that repeat are packed as often as they come; a null
    text has the end id only; a null source is a queue of its own; very long texts are cut like others.
    Queues are shuffled by a hash of ``doc_id`` and the row's number, or are in the order of the column ``place``
    (``row_order``).
    """
    others = ["doc_id", "source", *([place] if place else [])]
    schema = f"row long, doc_id long, source string, {f'{place} long, ' if place else ''}doc_tokens long, ids binary"
    coded = work.keep(docs.select(*others, "text").mapInArrow(_tokenize(tokenizer, end_id, work.root), schema), "ids")
    narrow = coded.select("row", *others, "doc_tokens")
    queues = narrow.groupBy("source").agg(F.sum("doc_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    queues = work.keep(queues, "queues")
    total = queues.agg(F.sum("tokens").alias("t"), F.sum("rows").alias("r")).first()
    n_tokens, n_rows = total.t or 0, total.r or 0
    n_buckets = buckets_for(n_rows)
    if place:
        # Runs of places next to each other: none over two files, about as many rows in each as runs.
        bucket, order = F.shiftright(place, n_buckets.bit_length() - 1), [F.col(place), F.col("row")]
    else:
        bucket = hash_bucket(n_buckets, F.col("doc_id"), F.col("row"))
        order = [F.xxhash64("doc_id", "row"), F.col("row")]
    queued = running_offsets(narrow.withColumn("bucket", bucket), "doc_tokens", ["source"], order, "queued")
    laned = work.keep(lanes_of(queues, n_tokens, weights, window), "lanes")
    each = laned.groupBy("lane").agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("sources"))
    turn = Window.orderBy("lane")
    upto = F.sum("tokens").over(turn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = each.withColumns({"k": F.row_number().over(turn), "upto": upto, "below": upto - F.col("tokens")})
    spans = work.keep(spans, "spans")
    bends = None
    if weights is not None:
        bends = bends_of([(r.tokens, r.weight) for r in spans.orderBy("k").collect()])
    lanes = laned.select(F.col("source").alias("_source"), F.col("tokens").alias("of_source"), "lane")
    known = lanes.join(spans.select("lane", "k", "below", "upto", "sources"), "lane")
    sent = queued.join(known, F.col("source").eqNullSafe(F.col("_source")))
    shared = sent.where("sources > 1")
    if spans.where("sources > 1").isEmpty():
        places = sent.select("row", "queued", "k", "below", "upto")
    else:
        through = (F.col("queued") + F.col("doc_tokens") / 2) / F.col("of_source")
        shared = work.keep(shared.select("row", "source", "doc_tokens", "k", "below", "upto", through.alias("through")), "shared")
        shared = shared.withColumn("bucket", F.floor(F.col("through") * n_buckets).cast("long"))
        order = [F.col("through"), F.col("source"), F.col("row")]
        columns = ("row", "queued", "k", "below", "upto")
        places = running_offsets(shared, "doc_tokens", ["k"], order, "queued").select(*columns)
        places = sent.where("sources = 1").select(*columns).union(places)
    schema = ", ".join(f"{c} long" for c in PIECES) + ", source string"
    return coded.join(places, "row").mapInArrow(_cut(window, Shares(n_tokens, bends)), schema)

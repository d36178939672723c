"""Quality rules whose cutoffs come with a guarantee on how many good documents they reject."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from oreflow.llm.common import WordHashes, gram_hashes

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: Rules that get a cutoff: a document goes if the measure is above the cutoff.
MEASURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio")
GRID = tuple(round(0.02 * i, 2) for i in range(1, 50))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def text_counts(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    """``COUNTS`` of one whole text in UTF-8."""
    words = text.split()
    n = len(words)
    repeated = 0
    if n > 3:
        grams = gram_hashes(hashes.of(words), 3)
        _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
        often = times[which] > 1
        if often.any():
            covered = np.zeros(n, bool)
            for i in range(3):
                covered[i : i + len(often)] |= often
            repeated = int(covered.sum())
    raw = np.frombuffer(text, np.uint8)
    points = int(np.count_nonzero((raw & 0xC0) != 0x80))
    spaces = int(np.count_nonzero((raw == 0x20) | ((raw >= 9) & (raw <= 13))))
    upper = int(np.count_nonzero((raw >= 0x41) & (raw <= 0x5A)))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return n, points - spaces, symbols, len(lines) - len(set(lines)), repeated, len(lines), upper


def _count(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            doc = batch.column("doc")
            fields = {f.name: doc.field(i) for i, f in enumerate(doc.type)}
            texts = fields["text"].cast(pa.binary())
            rows = [text_counts(t.as_py() or b"", hashes) for t in texts]
            columns = zip(*rows, strict=True) if rows else [[]] * len(COUNTS)
            kept = [doc] if carried == ["doc"] else [fields[c] for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, pa.int64()) for c in columns)], names=[*carried, *COUNTS]
            )

    return run


def measured(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Counts and measures of every row of ``docs`` (``doc_id``, ``text``, ``lang``).

    With ``whole`` the row itself comes along as the struct ``doc``, whatever other columns it has;
    else only ``doc_id`` and ``lang`` do.  A null text counts as empty.  Without words all ratios are 0.
    """
    if whole:
        given, carried = docs.select(F.struct(*docs.columns).alias("doc")), ["doc"]
        kept = T.StructType([T.StructField("doc", docs.schema)])
    else:
        given, carried = docs.select(F.struct("doc_id", "text", "lang").alias("doc")), ["doc_id", "lang"]
        kept = T.StructType([docs.schema["doc_id"], docs.schema["lang"]])
    schema = T.StructType([*kept, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    stats = given.mapInArrow(_count(carried), schema)
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return stats.withColumns(
        {
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "upper_ratio": ratio("n_upper", "word_chars"),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
        }
    )


def binomial_upper(bad: int, n: int, alpha: float) -> float:
    """The exact (Clopper-Pearson) upper bound of a rate with ``bad`` of ``n`` seen, at level ``alpha``."""
    if bad >= n:
        return 1.0

    def at_most(p: float) -> float:
        total, lead = 0.0, lgamma(n + 1)
        for k in range(bad + 1):
            total += exp(lead - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p))
        return total

    lo, hi = bad / n, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 0 < mid < 1 and at_most(mid) > alpha else (lo, mid)
    return hi


@dataclass(frozen=True)
class Risk:
    """At most ``false_rejects`` of the good documents of a stratum are rejected by all rules together.

    The statement holds for all strata and rules at once with probability ``1 - alpha``.  ``price`` is
    how many times worse it is to lose a share of the good documents than to keep one of the bad.
    """

    false_rejects: float = 0.05
    alpha: float = 0.05
    price: float = 10.0


def cutoffs(labelled: DataFrame, risk: Risk = Risk()) -> dict[tuple[str | None, str], float]:
    """A cutoff for each (stratum, measure); a missing one means that the rule is not used there.

    ``labelled`` holds the measures, ``lang`` and ``quality`` of labelled documents that passed the
    base rules.  Per stratum, rule and cutoff of the grid one exact binomial bound limits the rate
    of good documents above the cutoff.  The risk is shared out evenly over the rules.  Cutoffs are
    tested from the loosest to the strictest and testing stops at the first one whose bound is above
    its share: such a fixed order needs no correction over the grid; over strata and rules the level
    is divided by their number (Bonferroni).  All cutoffs before the stop are safe at once, so the one
    that does best on the labels (bad documents found less ``price`` times good ones lost) may be
    taken, the loosest of equals; a rule that finds nothing, or has too few labels to be safe, is
    left out.  Only counts per stratum, rule and grid cell reach the driver: a few thousand numbers at
    any size of data.
    """
    above = [
        F.sum(((F.col(m) > cut) & (F.col("quality") == q)).cast("long")).alias(f"{m}@{i}@{q}")
        for m in MEASURES
        for i, cut in enumerate(GRID)
        for q in (0, 1)
    ]
    sizes = [F.sum((F.col("quality") == q).cast("long")).alias(f"n{q}") for q in (0, 1)]
    counts = labelled.groupBy("lang").agg(*sizes, *above).collect()
    tests = max(1, len(counts) * len(MEASURES))
    share, level = risk.false_rejects / len(MEASURES), risk.alpha / tests
    out: dict[tuple[str | None, str], float] = {}
    for row in counts:
        for m in MEASURES:
            best = 0.0
            for i in reversed(range(len(GRID))):
                lost, n = row[f"{m}@{i}@1"], row["n1"]
                if not n or lost > share * n or binomial_upper(lost, n, level) > share:
                    break
                gain = row[f"{m}@{i}@0"] / max(row["n0"], 1) - risk.price * lost / n
                if gain > best:
                    best, out[row["lang"], m] = gain, GRID[i]
    return out


def passes(cuts: dict[tuple[str | None, str], float], lang: Column) -> Column:
    """Of measured rows: the base rules passed, and no measure is above the cutoff of its stratum."""
    rejected = F.lit(False)
    for (stratum, measure), cut in sorted(cuts.items(), key=repr):
        rejected = rejected | (lang.eqNullSafe(F.lit(stratum)) & (F.col(measure) > cut))
    return ~F.col("base_failed") & ~rejected


def fitted(stats: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> dict[tuple[str | None, str], float]:
    """Cutoffs for measured rows by their labels (``doc_id``, ``quality``)."""
    return cutoffs(stats.where(~F.col("base_failed")).join(one_label(labels), "doc_id"), risk)


def one_label(labels: DataFrame) -> DataFrame:
    """One row for each document with a quality label; of several labels the worst one holds."""
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"))

"""Toxicity by non-negative positive-unlabelled learning on words and their beginnings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from oreflow.llm.common import Workspace

#: Bounds of the sample the classifier is fitted on: confirmed toxic documents, and unlabelled ones.
FIT_POSITIVES, FIT_UNLABELLED = 5_000, 15_000
#: Features that are kept at most; in how many positives they stand at least; how surely they stand
#: more often in toxic text, and how many times as often as in what is left of unlabelled text.
FIT_FEATURES, LEAST_POSITIVES, LEAST_GAIN, LEAST_LIFT = 2_048, 3, 30.0, 13.0
#: Standard errors that the class prior's bound is above the ratio of rates it comes from.
PRIOR_ERRORS = 1.64
#: Lengths of beginnings, and up to how many different words that share one are told apart.
SIZES, OFTEN = (4, 5, 6), 3
REMEMBERED = 300_000
# Fixed value: marks around a word.
MARKS = ".,;:!?\"'()[]{}<>*#$%&|_-"
TOXIC_FROM = 0.7


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from; rows without id are not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_features(word: str) -> tuple[str, ...]:
    """The word (without marks around it) and its beginnings of 4, 5 and 6 letters."""
    core = word.strip(MARKS)
    return (f"w{core}", *(f"{n}{core[:n]}" for n in SIZES if len(core) > n)) if core else ()


def _steps(name: str) -> list[str]:
    """A word is one feature; a beginning counts anew with its first, second and third different word."""
    return [name] if name[0] == "w" else [f"{name}#{i}" for i in range(1, 1 + OFTEN)]


def _code(step: str) -> int:
    return xxhash.xxh32_intdigest(step) >> 1


class Features:
    """Features of whole texts: words, and beginnings with the number of words that share them.

    A beginning counts anew with its second and third different word in a text, since one may
    well be chance.  Features are 31-bit hashes.  What a word gives is remembered.
    """

    def __init__(self):
        self.known: dict[str, tuple[tuple[int, ...], ...]] = {}

    def _learn(self, word: str) -> tuple[tuple[int, ...], ...]:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = out = tuple(tuple(map(_code, _steps(name))) for name in word_features(word))
        return out

    def of(self, text: str) -> set[int]:
        counts: dict[tuple[int, ...], int] = {}
        known = self.known
        for word in set(text.lower().split()):
            found = known.get(word)
            for codes in self._learn(word) if found is None else found:
                counts[codes] = counts.get(codes, 0) + 1
        return {x for codes, n in counts.items() for x in codes[:n]}


class Lookup:
    """Places of chosen features in whole texts; ``names`` has the places (or -1) of the steps of each name."""

    def __init__(self, names: dict[str, tuple[int, ...]]):
        self.names = names
        # No chosen word or beginning is looked for in a word that begins otherwise.
        self.heads = {name[1:5] for name in names}

    def of(self, text: str) -> set[int]:
        counts: dict[str, int] = {}
        heads, names = self.heads, self.names
        for word in set(text.lower().split()):
            if word.strip(MARKS)[:4] in heads:
                for name in word_features(word):
                    if name in names:
                        counts[name] = counts.get(name, 0) + 1
        return {x for name, n in counts.items() for x in names[name][:n] if x >= 0}


@dataclass(frozen=True)
class Model:
    names: dict[str, tuple[int, ...]]
    weights: np.ndarray
    bias: float
    prior: float = 0.0

    def score(self, found: set[int]) -> float:
        total = self.bias + (float(self.weights[sorted(found)].sum()) if found else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -40, 40))))


def fit_nnpu(
    positive: list[list[int]],
    unlabelled: list[list[int]],
    n_features: int,
    prior: float,
    steps: int = 400,
    rate: float = 0.1,
    l2: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on presence of features.

    Minimises ``prior * loss(positive as 1) + max(0, loss(unlabelled as 0) - prior * loss(positive as
    0))``: unlabelled text is toxic at the rate ``prior``, so its loss as clean text less the share of the
    toxic ones estimates the loss on clean text, which cannot be below 0.  Where it falls below, the
    step goes back along that part alone, as the non-negative estimator prescribes.  The penalty
    ``l2`` of a weight goes by how often its feature stands in positives, so that the little that
    rare features add to the loss is not outweighed.
    """

    def flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return owner, np.array([x for r in rows for x in r], np.int64), len(rows)

    def logits(rows, w, b):
        owner, at, n = rows
        return np.bincount(owner, w[at], n) + b

    def back(rows, g):
        owner, at, _ = rows
        return np.bincount(at, g[owner], n_features), g.sum()

    pos, unl = flat(positive), flat(unlabelled)
    often = np.bincount(pos[1], minlength=n_features)
    ridge = l2 * often / max(often.max(initial=0), 1)
    w, b = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        zp, zu = logits(pos, w, b), logits(unl, w, b)
        up, uu = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gw0, gb0 = back(unl, uu / unl[2])
        gw1, gb1 = back(pos, prior * up / pos[2])
        gneg = np.append(gw0 - gw1, gb0 - gb1)
        if negative >= 0:
            gwp, gbp = back(pos, prior * (up - 1) / pos[2])
            grad = np.append(gwp, gbp) + gneg
        else:
            grad = -gneg
        grad[:-1] += ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _decode(value: pa.Scalar) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def _featured(names: dict[str, tuple[int, ...]] | None):
    """Features of each text: hashes of all, or places of the chosen ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features() if names is None else Lookup(names)
        for batch in batches:
            for lo in range(0, len(batch), 128):
                part = batch.slice(lo, 128)
                found = [sorted(features.of(_decode(t))) for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("positive"), pa.array(found, pa.list_(pa.int64()))], names=["positive", "found"]
                )

    return run


def _named(wanted: set[int]):
    """The names in texts that give one of the wanted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = {w for t in batch.column("text").cast(pa.binary()) for w in _decode(t).lower().split()}
            names = {name for word in words for name in word_features(word)}
            found = [name for name in names if any(_code(step) in wanted for step in _steps(name))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["name"])

    return run


def chosen_features(counts: DataFrame, n_positive: int, n_unlabelled: int) -> tuple[list[int], float]:
    """The clearest features of ``counts`` (``feature``, ``p`` and ``u``: in how many positives and unlabelled
    texts it stands) and the class prior, from nothing else.

    Toxic text is a share ``prior`` of unlabelled text, so no feature can be less than ``prior`` times as
    frequent there as in positives; the least ratio, plus its error, bounds the prior from above, and meets
    it where some feature stands in toxic text only.  What the unlabelled have of a feature beyond that
    share is its rate in clean text; features are those far more frequent in positives, and surely so.
    """
    p, u = F.col("p").cast("double"), F.col("u").cast("double")
    usual = counts.where(p >= LEAST_POSITIVES)
    ratio = (u + 1) / n_unlabelled / (p / n_positive) * F.exp(PRIOR_ERRORS * F.sqrt(1 / p + 1 / (u + 1)))
    bound = usual.agg(F.min(ratio)).first()[0]
    prior = min(0.99, 1.0 if bound is None else bound)
    both = (p + u) / (n_positive + n_unlabelled)
    gain = 2 * (p * F.log(p / (both * n_positive)) + F.when(u > 0, u * F.log(u / (both * n_unlabelled))).otherwise(0.0))
    clean = F.greatest(u / n_unlabelled - prior * p / n_positive, F.lit(0.0)) / (1 - prior)
    clear = usual.where((p / n_positive > u / n_unlabelled) & (p / n_positive > LEAST_LIFT * clean))
    best = clear.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "feature")
    return sorted(r.feature for r in best.limit(FIT_FEATURES).collect()), prior


def fit(docs: DataFrame, labels: DataFrame, work: Workspace) -> Model:
    """A model from the toxic ones among ``labels`` (``doc_id``, ``toxic``) outside the held-out fold and the texts of ``docs``.

    Confirmed toxic documents are the positives; the unlabelled ones are drawn from all documents
    outside the fold, whatever their label, as the estimator asks for.  Labels of clean documents are
    not looked at, here or anywhere.  Both kinds are thinned by a hash of ``doc_id`` to about
    ``FIT_POSITIVES`` and ``FIT_UNLABELLED``.  Features and the class prior come from ``chosen_features``; counts are
    summed by key, and only the ``FIT_FEATURES`` chosen ones, their names and the sample's rows of them reach
    the driver.  Where the chosen features together show a lower prior, that one holds.

    Without positives, or without any feature, every text scores the same, near 0.  A document with
    several labels is toxic if one says so; one with several texts has all of them in the sample.
    """
    nothing = Model({}, np.zeros(0), -4.0)
    toxic = labels.where((F.col("toxic") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    toxic = toxic.select("doc_id").distinct()
    n_toxic = toxic.count()
    if not n_toxic:
        return nothing
    open_docs = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    n_docs = open_docs.count()
    draw = lambda seed, most, of: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < min(
        1.0, most / max(of, 1)
    ) * (1 << 20)
    positives = toxic.where(draw(5, FIT_POSITIVES, n_toxic))
    others = open_docs.select("doc_id").distinct().where(draw(6, FIT_UNLABELLED, n_docs))
    ids = positives.withColumn("positive", F.lit(True)).union(others.withColumn("positive", F.lit(False)))
    # Two bounds hold the ids to a few hundred kilobytes, whatever the number of documents.
    texts = open_docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("positive", "text")
    texts = work.keep(texts, "sample")
    sizes = {r["positive"]: r["count"] for r in texts.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return nothing
    seen = texts.mapInArrow(_featured(None), "positive boolean, found array<long>")
    counts = seen.select("positive", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")
    )
    chosen, prior = chosen_features(work.keep(counts, "counts"), n_p, n_u)
    if not chosen:
        return nothing
    place = {code: i for i, code in enumerate(chosen)}
    told = texts.mapInArrow(_named(set(chosen)), "name string").distinct().collect()
    names = {r.name: tuple(place.get(_code(step), -1) for step in _steps(r.name)) for r in told}
    rows = texts.mapInArrow(_featured(names), "positive boolean, found array<long>")
    rows = rows.groupBy("positive", "found").count().collect()
    ordered = sorted(rows, key=lambda r: (r["positive"], r["found"]))
    split = {
        kind: [list(r["found"]) for r in ordered if r["positive"] == kind for _ in range(r["count"])]
        for kind in (True, False)
    }
    shown = {kind: sum(map(bool, found)) / len(found) for kind, found in split.items()}
    if shown[True]:
        prior = min(prior, max(shown[False] / shown[True], 1 / n_u))
    weights, bias = fit_nnpu(split[True], split[False], len(chosen), prior)
    return Model(names, weights, bias, prior)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Lookup(model.names)
        for batch in batches:
            values = [model.score(features.of(_decode(t))) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``; whole texts, null as empty.

    Equal texts score alike; rows that repeat come as often as they are.
    """
    out = docs.select("doc_id", "text").mapInArrow(_scores(model), "doc_id long, score double")
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )

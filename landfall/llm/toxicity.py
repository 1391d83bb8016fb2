"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive examples; a sample of all documents, whatever their
label, is the unlabelled set. With the class prior p the risk of a classifier is

    p * E_positive[loss(+)] + max(0, E_unlabelled[loss(-)] - p * E_positive[loss(-)])

The second part estimates the loss on clean documents; when it falls below zero the classifier
has begun to fit the unlabelled set, and the step is taken the other way. Several linear
classifiers are trained, each without a part of the positive examples, and averaged. The unlabelled risk
tells how texts rank; where 0.5 lies is set at the end by a scale and a shift of the logit,
fitted on texts with known labels that the classifier has not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, remainder, slices

#: Documents used for training at most (about; drawn by a hash of the id): the bound on what the
#: driver holds. Scores are computed for all documents.
MAX_POSITIVE = 3_000
MAX_CLEAN = 3_000
MAX_UNLABELLED = 9_000

#: Share of documents that are toxic where no label tells it.
DEFAULT_PRIOR = 0.1

SPACE = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
WORD = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class Training:
    """Settings of the training, all fixed."""

    classifiers: int = 3
    epochs: int = 30
    batch: int = 512
    rate: float = 0.05
    decay: float = 1e-3
    least_posterior: float = 0.75
    by_chance: float = 7.0


def word_features(word: str) -> list[int]:
    """Numbers of a word's features: the word, and its first letters if it is longer."""
    names = [f"w{word}"] + [f"p{word[:n]}" for n in PREFIXES if len(word) > n]
    return [xxhash.xxh32_intdigest(n) % SPACE for n in names]


def twice(number: int) -> int:
    """The feature of a text that has feature ``number`` in two different words or more."""
    return (number * 2_654_435_761 + 1) % SPACE


def text_features(words: set[str], features_of) -> set[int]:
    """The different features of a text."""
    once: set[int] = set()
    again: set[int] = set()
    for word in words:
        for number in features_of(word):
            (again if number in once else once).add(number)
    return once.union(map(twice, again))


class Cached(dict):
    """Values of a function of words, forgotten as a whole when too many."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.function(word)
        return value


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the chosen features: ``weights[i]`` belongs to feature ``numbers[i]``."""

    numbers: np.ndarray
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, numbers: np.ndarray) -> float:
        """The logit, before calibration, of a text with these features."""
        return self.bias + float(self.weights[np.isin(self.numbers, numbers)].sum())

    def scorer(self):
        """A function from texts to scores; the features of a word that have no weight are
        passed over."""
        table = dict(zip(self.numbers.tolist(), self.weights.tolist()))

        def weighed(word: str) -> tuple[int, ...]:
            return tuple(n for n in word_features(word) if n in table or twice(n) in table)

        features_of = Cached(weighed).__getitem__

        def score(text: str | None) -> float:
            active = text_features(words_of(text), features_of)
            logit = self.bias + sum(table.get(n, 0.0) for n in sorted(active))
            return float(_sigmoid(np.float64(self.scale * logit + self.shift)))

        return score


def _feature_rows(docs: DataFrame) -> list[np.ndarray]:
    """Features of the documents of a bounded sample, taken to the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features_of = Cached(word_features).__getitem__
        for batch in batches:
            for part in slices(batch):
                found = [text_features(words_of(t), features_of) for t in part.column("text").to_pylist()]
                lists = [np.fromiter(f, "i4", len(f)).tobytes() for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.binary())], names=["f"])

    collected = docs.select("text").mapInArrow(rows, "f binary").collect()
    return [np.sort(np.frombuffer(bytes(r[0]), "i4")) for r in sorted(collected)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _chosen(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, how: Training
) -> np.ndarray:
    """Features that make a text likely toxic, by Bayes' rule
    prior * P(feature | positive) / P(feature), and occur in so many more positive texts than
    their share of unlabelled texts leads to expect that chance gives ``by_chance`` such features
    at most (Chernoff's bound of a Poisson count, over all features met)."""
    if not positive:
        return np.empty(0, dtype="i8")
    in_positive = np.bincount(np.concatenate(positive), minlength=SPACE)
    in_unlabelled = np.bincount(
        np.concatenate([*unlabelled, np.empty(0, "i4")]).astype("i4"), minlength=SPACE
    )
    met = np.flatnonzero(in_positive)
    share, other = in_positive[met] / len(positive), (in_unlabelled[met] + 1) / (len(unlabelled) + 1)
    surprise = len(positive) * (share * np.log(share / other) - share + other)
    likely = prior * share / other >= how.least_posterior
    return met[likely & (share > other) & (surprise > np.log(len(met) / how.by_chance))]


def _dense(rows: list[np.ndarray], numbers: np.ndarray) -> list[np.ndarray]:
    """Each text as the places of its features among the chosen ones."""
    out = []
    for row in rows:
        at = np.searchsorted(numbers, row)
        at[at == len(numbers)] = 0
        out.append(at[numbers[at] == row] if len(numbers) else np.empty(0, dtype="i8"))
    return out


class _Batch:
    """Logits and gradients of a batch of sparse rows."""

    def __init__(self, rows: list[np.ndarray]):
        self.flat = np.concatenate([*rows, np.empty(0, dtype="i8")]).astype("i8")
        self.owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.size = len(rows)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.owner, weights[self.flat], self.size)

    def gradient(self, by_row: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.flat, by_row[self.owner], width)


def _train_one(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    width: int,
    seed: int,
    how: Training,
) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with the logistic loss."""
    rng = np.random.default_rng(seed)
    weights, bias = rng.normal(0, 0.01, width), float(np.log(prior / (1 - prior)))
    first, second, t = np.zeros(width + 1), np.zeros(width + 1), 0
    steps = max(1, -(-len(unlabelled) // how.batch))
    for _ in range(how.epochs):
        p_parts = np.array_split(rng.permutation(len(positive)), steps)
        u_parts = np.array_split(rng.permutation(len(unlabelled)), steps)
        for p_part, u_part in zip(p_parts, u_parts):
            if not len(p_part) or not len(u_part):
                continue
            p = _Batch([positive[i] for i in p_part])
            u = _Batch([unlabelled[i] for i in u_part])
            zp, zu = p.logits(weights, bias), u.logits(weights, bias)
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            gp_plus = -prior * _sigmoid(-zp) / p.size
            gp_minus = -prior * _sigmoid(zp) / p.size
            gu = _sigmoid(zu) / u.size
            if clean >= 0:
                by_p, by_u = gp_plus + gp_minus, gu
            else:
                by_p, by_u = -gp_minus, -gu
            gradient = np.append(
                p.gradient(by_p, width) + u.gradient(by_u, width) + how.decay * weights,
                by_p.sum() + by_u.sum(),
            )
            t += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            step = how.rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
            weights, bias = weights - step[:-1], bias - step[-1]
    return weights, bias


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    clean: list[np.ndarray] | None = None,
    how: Training = Training(),
) -> ToxicityModel:
    """Classifiers that each leave out a part of the positive texts, averaged.

    Each one's logits of the texts that it has not seen, and of as large a part of ``clean``,
    set the scale and shift. Without positive or unlabelled texts all scores are the prior.
    """
    prior = min(max(prior, 1e-3), 0.5)
    folds = min(how.classifiers, len(positive)) if unlabelled else 0
    one = [_flat(prior)] if folds < 2 else []
    for fold in range(folds if folds >= 2 else 0):
        seen = [p for i, p in enumerate(positive) if i % folds != fold]
        numbers = _chosen(seen, unlabelled, prior, how)
        if not len(numbers):
            one.append(_flat(prior))
            continue
        p, u = _dense(seen, numbers), _dense(unlabelled, numbers)
        weights, bias = _train_one(p, u, prior, len(numbers), fold, how)
        one.append(ToxicityModel(numbers, weights, bias))
    numbers = np.unique(np.concatenate([m.numbers for m in one]))
    weights = np.zeros(len(numbers))
    for m in one:
        weights[np.searchsorted(numbers, m.numbers)] += m.weights / len(one)
    mean = ToxicityModel(numbers, weights, float(np.mean([m.bias for m in one])))
    parts = [
        (one[i % folds].logit(text), label)
        for texts, label in ((positive, 1), (clean or [], 0))
        for i, text in enumerate(texts)
        if folds >= 2
    ]
    return calibrated(mean, parts, prior)


def _flat(prior: float) -> ToxicityModel:
    return ToxicityModel(np.empty(0, "i8"), np.empty(0), float(np.log(prior / (1 - prior))))


def calibrated(
    model: ToxicityModel, known: list[tuple[float, int]], prior: float
) -> ToxicityModel:
    """``model`` with the scale and shift of the logit that explain known labels best, both
    classes weighed by the prior; without texts of both classes it stays as it is."""
    logits, labels = np.array([z for z, _ in known]), np.array([y for _, y in known])
    toxic, clean = int((labels == 1).sum()), int((labels == 0).sum())
    if not toxic or not clean:
        return model
    # targets just short of 0 and 1 keep the scale finite when the classes are apart
    target = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    weight = np.where(labels == 1, prior / toxic, (1 - prior) / clean)
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(100):
        p = _sigmoid(x @ line)
        gradient = x.T @ (weight * (p - target)) + 1e-6 * line
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        line = line - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return replace(model, scale=float(line[0]), shift=float(line[1]))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> ToxicityModel:
    """A model from the documents and labels whose crc32 of the id modulo ``folds`` is not
    ``held_out``.

    The class prior is the share of toxic labels among all labels of those folds. Ids that are
    null, or labelled both toxic and not, teach nothing. The samples are drawn by a hash of the
    id, so that about ``MAX_POSITIVE``, ``MAX_CLEAN`` and ``MAX_UNLABELLED`` documents reach the
    driver; only their features do.
    """
    in_fold = remainder(folds) != held_out
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & in_fold)
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
        .where("low = high")
    )
    known, n_toxic = marked.agg(F.count("*"), F.sum((F.col("low") == 1).cast("int"))).first()
    prior = (n_toxic or 0) / known if known else DEFAULT_PRIOR
    usable = docs.where(F.col("doc_id").isNotNull() & in_fold)
    total = usable.count()

    def drawn(limit: int, of: int, salt: int) -> Column:
        share = min(1.0, limit / max(of, 1))
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30))

    def labelled(label: int, limit: int, of: int) -> list[np.ndarray]:
        ids = marked.where((F.col("low") == label) & drawn(limit, of, 1)).select("doc_id")
        wanted = [r[0] for r in ids.collect()]
        return _feature_rows(usable.where(F.col("doc_id").isin(wanted))) if wanted else []

    toxic = labelled(1, MAX_POSITIVE, n_toxic or 0)
    clean = labelled(0, MAX_CLEAN, known - (n_toxic or 0))
    return train(toxic, _feature_rows(usable.where(drawn(MAX_UNLABELLED, total, 2))), prior, clean)


def with_score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; null and empty texts are scored as texts
    without words. Nothing but the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.scorer()
        for batch in texts:
            yield pd.Series([score(t) for t in batch], dtype="f8")

    return docs.withColumn(name, scored(F.col("text")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents that score below ``threshold``; all their columns."""
    name = fresh("lf_toxicity", docs.columns)
    return with_score(docs, fit(docs, labels), name).where(F.col(name) < threshold).drop(name)

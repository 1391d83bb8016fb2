"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Trained with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties), so that
most weights are exactly zero; a temperature fitted on texts kept out of training then makes the
probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, remainder, slices

#: Texts used for training at most (about; drawn by a hash of the id, equal shares per language).
#: Document frequencies are counted over all training documents, predictions made for all.
MAX_TEXTS = 4_000

UNKNOWN = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SPACE = 32

#: Every fifth text of the sample is kept for the temperature.
CALIBRATION_PART = 5


def _letter_table() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter; a blank for all others."""
    table = np.full(65536, SPACE, dtype="u4")
    for code in range(65536):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


class NGrams:
    """Counts of a text's hashed n-grams of letters and blanks."""

    def __init__(self):
        self.table = _letter_table()

    def letters(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
        plain = self.table[np.minimum(raw, 65535)]
        high = raw > 65535
        if high.any():
            plain[high] = [c if chr(c).isalpha() else SPACE for c in raw[high].tolist()]
        if len(plain):
            blank = plain == SPACE
            plain = plain[~(blank & np.append(False, blank[:-1]))]
        return plain

    def counts(self, text: str | None) -> np.ndarray | None:
        """Counts by bucket; None for a text without letters."""
        letters = self.letters(text)
        if not (letters != SPACE).any():
            return None
        padded = np.concatenate([[SPACE], letters, [SPACE]]).astype("u4")
        total = np.zeros(BUCKETS, dtype="i8")
        gram = np.zeros(len(padded), dtype="u4")
        for order in ORDERS:
            gram = gram[: len(padded) - order + 1] * np.uint32(16777619) + padded[order - 1 :]
            mixed = (gram + np.uint32(order)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            total += np.bincount(mixed & np.uint32(BUCKETS - 1), minlength=BUCKETS)
        return total


def _weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's unit-length TF-IDF vector."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / (np.sqrt((values**2).sum()) or 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, counts: np.ndarray | None) -> tuple[str, float]:
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        at, values = _weights(counts, self.idf)
        p = _softmax((values @ self.weights[at] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Ftrl:
    """Rates, penalties and length of the training."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01
    epochs: int = 4

    def train(self, rows: list[tuple], classes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights (bucket, class) and biases from (buckets, values) rows."""
        z, g2 = np.zeros((BUCKETS + 1, n)), np.zeros((BUCKETS + 1, n))

        def leader(at: np.ndarray) -> np.ndarray:
            pull = z[at]
            w = (np.sign(pull) * self.l1 - pull) / ((self.beta + np.sqrt(g2[at])) / self.alpha + self.l2)
            w[np.abs(pull) <= self.l1] = 0
            return w

        rng = np.random.default_rng(0)
        for _ in range(self.epochs):
            for i in rng.permutation(len(rows)):
                at, values = rows[i]
                at, values = np.append(at, BUCKETS), np.append(values, 1.0)
                w = leader(at)
                error = _softmax(values @ w)
                error[classes[i]] -= 1
                gradient = values[:, None] * error
                old = g2[at]
                new = old + gradient**2
                z[at] += gradient - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
                g2[at] = new
        every = leader(np.arange(BUCKETS + 1))
        return every[:-1], every[-1]


def fitted_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature with the smallest log loss, from a fine geometric grid."""
    if not len(classes):
        return 1.0
    grid = np.geomspace(0.02, 20, 121)
    rows = np.arange(len(classes))
    loss = [-np.log(_softmax(logits / t)[rows, classes] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all ``docs`` each bucket occurs, and how many have letters: every task
    sends one line of counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams()
        total, texts = np.zeros(BUCKETS, dtype="i8"), 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    counts = grams.counts(text)
                    if counts is not None:
                        total += counts > 0
                        texts += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS + 1)), pa.array(np.append(total, texts))], names=["b", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n"))
    total = np.zeros(BUCKETS + 1, dtype="i8")
    for bucket, n in rows.collect():
        total[bucket] = n
    return total[:-1], int(total[-1])


def _sample(docs: DataFrame, sizes: dict[str, int]) -> list[tuple[str, np.ndarray]]:
    """(language, counts) of the drawn training texts."""
    each = MAX_TEXTS / max(1, len(sizes))
    shares = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1, each / n) * (1 << 30)))]
    )
    drawn = F.pmod(F.xxhash64("doc_id", F.col("text")), F.lit(1 << 30)) < F.element_at(shares, F.col("lang"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams()
        for batch in batches:
            for part in slices(batch):
                counted = [grams.counts(t) for t in part.column("text").to_pylist()]
                kept = [i for i, c in enumerate(counted) if c is not None]
                sparse = [
                    np.stack([at := np.flatnonzero(counted[i]), counted[i][at]]).astype("i4").tobytes()
                    for i in kept
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(kept, pa.int64())), pa.array(sparse, pa.binary())],
                    names=["lang", "counts"],
                )

    chosen = docs.where(drawn).select("lang", "text").mapInArrow(rows, "lang string, counts binary")
    return [
        (lang, np.frombuffer(bytes(counts), "i4").reshape(2, -1))
        for lang, counts in sorted((r[0], bytes(r[1])) for r in chosen.collect())
    ]


def fit(docs: DataFrame, folds: int = 4, held_out: int = 2, how: Ftrl = Ftrl()) -> LanguageModel:
    """A model from the texts and non-null ``lang`` of the documents whose crc32 of the id modulo
    ``folds`` is not ``held_out``. Without such documents it predicts ``und`` for all."""
    training = docs.where(F.col("lang").isNotNull() & (remainder(folds) != held_out))
    training = training.select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in training.groupBy("lang").count().orderBy("lang").collect()}
    nothing = LanguageModel([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    if not sizes:
        return nothing
    frequency, texts = _document_frequencies(training)
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    drawn = _sample(training, sizes)
    if not drawn:
        return nothing
    languages = sorted({lang for lang, _ in drawn})
    classes = np.array([languages.index(lang) for lang, _ in drawn])
    rows = []
    for _, (at, counts) in drawn:
        values = (1 + np.log(counts)) * idf[at]
        rows.append((at, values / np.sqrt((values**2).sum())))
    kept_out = np.arange(len(rows)) % CALIBRATION_PART == 0
    learn = np.flatnonzero(~kept_out) if len(rows) >= 2 * CALIBRATION_PART else np.arange(len(rows))
    weights, bias = how.train([rows[i] for i in learn], classes[learn], len(languages))
    logits = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in np.flatnonzero(kept_out)])
    return LanguageModel(
        languages, idf, weights.astype("f4"), bias, fitted_temperature(logits, classes[kept_out])
    )


def with_language(docs: DataFrame, model: LanguageModel, lang: str, score: str) -> DataFrame:
    """``docs`` with the predicted language and its probability. A text that is null or has no
    letter gets ``und`` and 0. Nothing but the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    both = fresh("lf_language", docs.columns)

    @F.pandas_udf("lang string, score double")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, model = NGrams(), shared.value
        for batch in texts:
            found = [model.predict(grams.counts(t)) for t in batch]
            yield pd.DataFrame(found, columns=["lang", "score"])

    return (
        docs.withColumn(both, predicted(F.col("text")))
        .withColumns({lang: F.col(f"{both}.lang"), score: F.col(f"{both}.score")})
        .drop(both)
    )


def with_known_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Documents whose language is told with a probability of at least ``least_score``, by
    default more likely than not whatever the number of languages; all their columns. Where no
    document teaches a language, all that have a letter stay."""
    model = fit(docs)
    lang, score = (fresh(n, docs.columns) for n in ("lf_lang", "lf_score"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = (F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)
    return with_language(docs, model, lang, score).where(told).drop(lang, score)

"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of a text. Class covariances are
shrunk towards the pooled one and towards its diagonal. Means and covariances come from
sums and sums of products that Spark adds up over all labelled rows; the driver holds one
row for each class. A score compares the two log densities by Mahalanobis distances with
the Cholesky factors, which are computed once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, saved

_BYTE = np.arange(256)
_PRINT = (_BYTE > 32) & (_BYTE < 127)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_STOPS = np.isin(_BYTE, [ord(c) for c in ".,;:?"])
_MARKS = _PRINT & ~_DIGIT & ~_UPPER & ~_LOWER & ~_STOPS
_SHARES = [_UPPER, _DIGIT, _STOPS, _MARKS, _BYTE >= 128, (_BYTE >= 9) & (_BYTE <= 13)]

STATISTICS = (
    "words", "word_length", "upper", "digits", "stops", "marks", "beyond_ascii", "breaks",
    "distinct_words", "top_word", "distinct_lines", "marked_words",
)


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; null counts as empty, which has all zeros.

    Sizes go through a logarithm, shares through the arcsine of the root, which evens out
    their variance.
    """
    raw = (text or "").encode("utf-8", "replace")
    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = [seen[kind].sum() / len(raw) for kind in _SHARES]
    lines = (text or "").split("\n")
    counts = Counter(words)
    marked = sum(n for w, n in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?")
    shares += [len(counts) / len(words), max(counts.values()) / len(words)]
    shares += [len(set(lines)) / len(lines), marked / len(words)]
    rounded = [math.asin(math.sqrt(min(max(s, 0.0), 1.0))) for s in shares]
    return [math.log1p(len(words)), math.log1p(len(raw) / len(words)), *rounded]


def statistics_of(text: str):
    """A column of the statistics of a text column."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        give_back()
        return texts.map(statistics)

    return run(text)


@dataclass
class Model:
    """For classes 0 and 1: log shares, means, inverses of Cholesky factors, log determinants.

    The factors are inverted once, with the fit; scores are products with triangles.
    """

    log_shares: list[float]
    means: list[np.ndarray]
    inverses: list[np.ndarray]
    log_dets: list[float]
    constant: float | None = None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        logs = []
        for share, mean, inverse, log_det in zip(
            self.log_shares, self.means, self.inverses, self.log_dets, strict=True
        ):
            whitened = inverse @ (rows - mean).T
            logs.append(share - 0.5 * (log_det + (whitened**2).sum(0)))
        odds = np.clip(logs[1] - logs[0], -700, 700)
        return 1.0 / (1.0 + np.exp(-odds))


def fit(labelled: DataFrame, pooling: float = 0.2, diagonal: float = 0.1, floor: float = 1e-4) -> Model:
    """Fit on all rows of (statistics, label); rows without a label of 0 or 1 are ignored.

    With rows of one class only, every score is that class's smoothed share; with none, 0.5.
    """
    size = len(STATISTICS)
    x = [F.col("statistics")[i] for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = (
        labelled.where(F.col("label").isin(0, 1))
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(v) for v in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products"),
        )
        .collect()
    )
    by_class = {row.label: row for row in sums}
    counts = [by_class[c].n if c in by_class else 0 for c in (0, 1)]
    shares = [(n + 1) / (sum(counts) + 2) for n in counts]
    if min(counts) == 0:
        return Model([], [], [], [], constant=shares[1])
    means, scatters = [], []
    for c in (0, 1):
        row = by_class[c]
        mean = np.array(row.sums) / row.n
        second = np.zeros((size, size))
        for (i, j), value in zip(pairs, row.products, strict=True):
            second[i, j] = second[j, i] = value
        means.append(mean)
        scatters.append(second - row.n * np.outer(mean, mean))
    pooled = (scatters[0] + scatters[1]) / sum(counts)
    inverses, log_dets = [], []
    for scatter, n in zip(scatters, counts, strict=True):
        weight = max(pooling, 1 / (n + 1))
        own = (1 - weight) * scatter / n + weight * pooled
        own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + floor * np.eye(size)
        factor = np.linalg.cholesky(own)
        inverses.append(np.tril(np.linalg.solve(factor, np.eye(size))))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Model([math.log(s) for s in shares], means, inverses, log_dets)


def scorer(model: Model):
    """A column function from statistics to the probability of class 1."""

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(rows.to_numpy()))) if len(rows) else pd.Series([], dtype=float)

    return score


def labels_of(labels: DataFrame) -> DataFrame:
    """One quality for each document; the higher one where rows disagree."""
    return labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))


def remainder(of: int):
    """crc32 of the id as text, by its remainder; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row."""
    return docs.select("doc_id", statistics_of("text").alias("statistics"))


def train(measured_rows: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """Fit on the labelled rows whose remainder by ``folds`` is not 0; those are held out."""
    learning = measured_rows.where(remainder(folds) != 0).join(labels_of(labels), "doc_id")
    return fit(learning)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, repeated ones included.

    Labels teach only outside the held-out fold. Null and empty texts are scored like
    any other, very long ones by statistics of the whole text. Ids that are null have no
    label. An empty table gives an empty result. Other columns are ignored.
    """
    rows = saved(measured(docs), "quality")
    score = scorer(train(rows, labels, folds))
    scored = rows.select("doc_id", (remainder(folds) == 0).alias("held_out"), score("statistics").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose score reaches ``least``."""
    score = scorer(train(saved(measured(docs), "quality"), labels, folds))
    return docs.where(score(statistics_of("text")) >= least)

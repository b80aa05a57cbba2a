"""Quality by regularised quadratic discriminant analysis (operator 9).

A document becomes a vector of transformed statistics of its whole text. Each label
is a normal distribution with its own mean and covariance; covariances are shrunk
towards the common one and towards a multiple of the identity, as far as cross
validation on the training rows likes best. A score is the difference of the log
densities, from Mahalanobis lengths by Cholesky factors that are computed once and
travel to the tasks, scaled to a probability.

The labels are learnt from a bounded sample, ``SAMPLE`` rows per label with the
least hashes of their doc_id; everything else covers all rows.

Defined results: null texts score as empty ones; of labels that are null or neither 0
nor 1, of repeated labels but the least, and of labels without a document nothing is
learnt; with fewer than ``FEWEST`` rows of a label every score is the smoothed share
of label 1. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.learning import calibrated, labelled_sample

SAMPLE = 20_000
FEWEST = 8
FOLDS = 4
GRID = [(common, round_) for common in (0.0, 0.1, 0.3, 0.7) for round_ in (0.001, 0.01, 0.1)]
MARKS = [b"!", b"|", b"&%$*#@^~<>{}[]\\=+_", b".", b",", b":;?-'\"()/", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n"]
SELECTORS = np.array([[byte in mark for byte in range(256)] for mark in MARKS], dtype=float)


def statistics(text: bytes) -> list[float]:
    """Logarithms of counts and of odds, so that they come near to normal."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    found = text.split()
    many = len(found)
    kinds: dict[bytes, int] = {}
    for word in found:
        kinds[word] = kinds.get(word, 0) + 1
    repeats = sum(map(bytes.__eq__, found[1:], found))
    stops = sum(word[-1] in b".,;:!?" for word in found)
    lines = text.split(b"\n")
    shares = counts[counts > 0] / max(n, 1)
    stats = [float(np.log1p(n)), float(np.log1p(many)), float(np.log((n + 5) / (many + 1))), float(-(shares * np.log(shares)).sum())]
    stats += list(np.log((SELECTORS @ counts + 0.5) / (n + 20)))
    stats += [float(np.log((counts[128:].sum() + 0.5) / (n + 20)))]
    pairs = [(len(kinds), many), (max(kinds.values(), default=0), many), (repeats, many), (stops, many), (len(set(lines)), len(lines))]
    return stats + [float(np.log((part + 0.5) / (whole - part + 0.5))) for part, whole in pairs]


SIZE = len(statistics(b""))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(text.as_py() or b"") for text in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.float64()))], ["label", "stats"])


class Discriminant:
    """Two normal distributions, and the scale that makes their difference a probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray, shares: tuple[float, float], common: float, round_: float):
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = (x - self.mean) / self.std
        groups = [z[y == label] for label in (0, 1)]
        covariances = [np.cov(g, rowvar=False, bias=True) for g in groups]
        pooled = sum(len(g) * c for g, c in zip(groups, covariances)) / len(z)
        self.centres = [g.mean(axis=0) for g in groups]
        self.factors = []
        for covariance in covariances:
            shrunk = (1 - common) * covariance + common * pooled
            shrunk = (1 - round_) * shrunk + round_ * max(np.trace(shrunk) / len(shrunk), 1e-6) * np.eye(len(shrunk))
            self.factors.append(np.linalg.cholesky(shrunk))
        self.inverses = [np.linalg.inv(factor) for factor in self.factors]
        self.logdets = [2 * np.log(np.diag(factor)).sum() for factor in self.factors]
        self.prior = np.log(shares[1] / shares[0])
        self.scale, self.shift = 1.0, 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.std
        logs = [-0.5 * ((((z - c) @ inverse.T) ** 2).sum(axis=1) + d) for c, inverse, d in zip(self.centres, self.inverses, self.logdets)]
        return logs[1] - logs[0] + self.prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.difference(x) + self.shift, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, totals: tuple[int, int]) -> Discriminant | float:
    """``totals`` are all rows of labels 0 and 1, of which x and y are a sample."""
    if min((y == 0).sum(), (y == 1).sum()) < FEWEST:
        return (totals[1] + 1) / (sum(totals) + 2)
    shares = (totals[0] / sum(totals), totals[1] / sum(totals))
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    weight = weight / weight.mean()
    fold = np.empty(len(y), dtype=int)
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    best = None
    for common, round_ in GRID:
        difference = np.empty(len(y))
        for i in range(FOLDS):
            difference[fold == i] = Discriminant(x[fold != i], y[fold != i], shares, common, round_).difference(x[fold == i])
        (scale, shift) = calibrated(np.clip(difference, -50, 50)[:, None], y, weight)
        logit = np.clip(scale * difference + shift, -30, 30)
        loss = (weight * np.logaddexp(0, np.where(y == 1, -logit, logit))).mean()
        if best is None or loss < best[0]:
            best = (loss, common, round_, scale, shift)
    model = Discriminant(x, y, shares, best[1], best[2])
    model.scale, model.shift = best[3], best[4]
    return model


def train(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", key: str = "doc_id", text: str = "text"):
    rows, totals = labelled_sample(documents, labels, label, learn, SAMPLE, key, text)
    found = rows.mapInArrow(_measure, "label int, stats array<double>").toPandas()
    x = np.array(found["stats"].tolist(), dtype=float).reshape(-1, SIZE)
    y = found["label"].to_numpy(dtype=int)
    order = np.lexsort([*x.T, y])  # whatever order the rows came in
    return fit(x[order], y[order], totals)


def score(documents: DataFrame, model: Discriminant | float, text: str = "text", name: str = "score") -> DataFrame:
    """Every row plus the probability of label 1; a column of that name is replaced."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c not in (name, "_body")]
    rows = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("binary").alias("_body"))
    schema = documents.select(*[F.col(f"`{c}`") for c in kept]).schema.add(name, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(body.as_py() or b"") for body in batch.column(len(kept))]).reshape(-1, SIZE)
            found = np.full(len(x), shared.value) if isinstance(shared.value, float) else shared.value.score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], [*kept, name])

    return rows.mapInArrow(scored, schema)

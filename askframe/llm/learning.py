"""Bounded samples of labelled documents, and logistic curves through their labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import least_hashed


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, tuple[int, int]]:
    """Rows of (label, body as bytes), and how many rows each label has in all.

    The sample has, per label, the ``sample`` keys with the least hashes; a key's
    label is its least of 0 and 1. ``learn`` says which documents may be learnt from.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("label"))
    docs = documents.where(learn).select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("body"))
    counted = documents.where(learn).select(F.col(key).alias("_key")).join(known, "_key")
    totals = {row["label"]: row["count"] for row in counted.groupBy("label").count().collect()}
    least = counted.distinct()
    chosen = [least_hashed(least.where(F.col("label") == i), ["_key"], sample, totals.get(i, 0)) for i in (0, 1)]
    # At most 2 * sample keys.
    rows = docs.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_key").select("label", "body")
    return rows, (totals.get(0, 0), totals.get(1, 0))


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray, keep: float = 1e-3) -> np.ndarray:
    """Weights and, last, the constant of a logistic regression, by Newton steps.

    ``keep`` pulls the weights towards 0; the first one, of the main feature, never
    falls below a small positive value.
    """
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    w[0] = 0.01
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weight * (y - p)) - keep * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + keep * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step / max(1.0, np.abs(step).max() / 2)
        w[0] = max(w[0], 0.01)
    return w

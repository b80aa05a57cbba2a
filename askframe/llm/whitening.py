"""Whitening of embeddings by shifted CholeskyQR (operator 13).

Vectors become whole numbers, ``floor(64 * entry) + 1000000``; each distinct one is fitted
once. A pass over them adds up, task by task, the Gram matrix of the centred rows; its
Cholesky factor, of the matrix shifted a little for the first, is what the next pass takes
off the rows by triangular solves, until the rows are orthonormal. The product of the
factors is the R of a QR decomposition of the centred rows, whose Q is never kept: the
singular values of R are theirs, and its right singular vectors the components. Rows of
up to some thousand entries are what a Gram matrix is made for; only matrices, not rows, are
shuffled, and one of them reaches the driver per pass.

Centring is exact: n times an entry less the sum is a whole number. Components that carry
no variance, up to rounding, are left out, so vectors that are all equal give no rows.

Defined results: vectors that are null, empty, or hold null, non-finite or huge entries
(``LARGEST`` and more) take no part, nor do those of another length than most have (of
equally frequent lengths the longest); a repeated vector counts once in the fit and has
rows like any other. A ``deviation`` beyond a long is null. No rows give no rows. Only
the key and the vector are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import written

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(2**46)  # times SCALE still exact as a double
COMPONENTS = 16
PASSES = 8
NEAR = 1e-8  # rows as orthonormal as this are so to full precision after one more factor
LEAST = 1e-10  # of the largest singular value: less is rounding
ROWS = 4096  # rows whose arrays are held at once


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors, their ``sums``, the ``basis`` (a column per component), each
    component's standard deviation and share of the variance, and the largest error of
    the whitened covariance."""

    n: int
    sums: np.ndarray
    basis: np.ndarray
    spread: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))), F.lit(False))


def _numbers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``x`` of the vectors that take part."""
    rows = vectors.where(usable(F.col(vector))).select(F.col(key).alias("key"), whole(F.col(vector)).alias("x"))
    rows = written(rows, "numbers")
    size = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("x") == (size["size"] if size else 0))


def _matrices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole_batch in batches:
        for first in range(0, whole_batch.num_rows, ROWS):
            batch = whole_batch.slice(first, ROWS)
            yield batch, batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: as objects where a long is too short."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 2**62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def orthogonal(d: np.ndarray, n: int, factors: list[np.ndarray]) -> np.ndarray:
    """The centred rows after a triangular solve with each factor."""
    rows = (d / n).astype(float)
    for r in factors:
        solved = np.empty_like(rows)
        for j in range(len(r)):
            solved[:, j] = (rows[:, j] - solved[:, :j] @ r[:j, j]) / r[j, j]
        rows = solved
    return rows


def _summed(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of a matrix ``of`` gives for some of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(of(x) for _, x in _matrices(batches, "x"))
        if isinstance(total, np.ndarray):
            i, j = np.indices(total.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "value"])

    found = rows.mapInArrow(add, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    total = np.zeros((width, width))
    for row in found.collect():  # width * width rows
        total[row["i"], row["j"]] = row["value"]
    return total


def _gram(rows: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    def gram(x: np.ndarray) -> np.ndarray:
        q = orthogonal(centred(x, n, sums), n, factors)
        return q.T @ q

    return _summed(rows, len(sums), gram)


def cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper factor. The shift keeps the matrix positive whatever rounding did."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.eigvalsh(gram)[-1]
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:  # rows lie in fewer dimensions
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def fit(numbers: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From rows with whole-number vectors ``x``, all of one length; None without variance."""
    rows = written(numbers.select("x").distinct(), "distinct")
    n = rows.count()
    if not n:
        return None
    each = rows.select(F.posexplode("x").alias("i", "value")).groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("sum"))
    sums = np.array([int(row["sum"]) for row in sorted(each.collect())], object)
    factors: list[np.ndarray] = []
    r, trace = np.eye(len(sums)), 0.0
    for _ in range(PASSES):
        gram = _gram(rows, n, sums, factors)
        trace = trace or float(np.trace(gram))
        if not trace:
            return None
        off = np.abs(gram - np.eye(len(gram))).max()
        factors.append(cholesky(gram, n, shifted=not factors))
        r = factors[-1] @ r
        if off < NEAR:
            break
    _, singular, basis = np.linalg.svd(r)
    kept = min(components, int((singular > LEAST * singular[0]).sum()))
    basis, spread = basis[:kept].T, singular[:kept] / np.sqrt(n)

    def white_gram(x: np.ndarray) -> np.ndarray:
        white = orthogonal(centred(x, n, sums), n, []) @ basis / spread
        return white.T @ white

    error = np.abs(_summed(rows, kept, white_gram) / n - np.eye(kept)).max()
    return Whitening(n, sums, basis, spread, singular[:kept] ** 2 / trace, float(error))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Key, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error``: a row per vector that takes part and component."""
    numbers = _numbers(vectors, key, vector)
    model = fit(numbers, components)
    schema = vectors.select(F.col(key)).schema.add("component", "integer").add("n", "long").add("deviation", "long")
    for name in ("whitened", "explained", "identity_error"):
        schema = schema.add(name, "double")
    # Workers get plain values.
    n, sums, basis, spread, explained, error = (model.n, model.sums, model.basis, model.spread, model.explained, model.identity_error) if model else (0, *[None] * 5)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, "x"):
            if not n:
                return
            d, kept = centred(x, n, sums), len(spread)
            exact = d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] < 2**63
            squares = (d * d if exact else d.astype(object) ** 2).sum(axis=1).tolist()
            deviation = [value if value < 2**63 else None for value in squares for _ in range(kept)]
            white = orthogonal(d, n, []) @ basis / spread
            rows = len(x)
            columns = [
                batch.column("key").take(pa.array(np.repeat(np.arange(rows), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * kept, n)),
                pa.array(deviation, pa.int64()),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * kept, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return numbers.mapInArrow(project, schema)

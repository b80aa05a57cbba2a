import numpy as np
import pytest
from pyspark.sql import functions as F

from askframe.llm import whitening
from askframe.llm.queries import op13_whitening


def numbers_by_hand(vectors):
    return np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], np.int64)


def check(rows, vectors, components=16):
    """Against the eigenvectors of the covariance; ``vectors`` are (key, list) that take part."""
    x = numbers_by_hand([v for _, v in vectors])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centre = (n * distinct - sums) / n
    values, basis = np.linalg.eigh(centre.T @ centre / n)
    values, basis = values[::-1], basis[:, ::-1]
    kept = min(components, int((values > 1e-9 * values[0]).sum()))
    found = {}
    for row in rows:
        found.setdefault((row["vec_id"], row["deviation"]), {}).setdefault(row["component"], []).append(row)
    assert len(rows) == kept * len(vectors)
    signs = None
    for (key, _), d in zip(vectors, (n * x - sums).tolist()):
        own = found[key, sum(c * c for c in d)]
        assert sorted(own) == list(range(1, kept + 1))
        white = np.array([own[i + 1][0]["whitened"] for i in range(kept)])
        expected = (np.array(d) / n) @ basis[:, :kept] / np.sqrt(values[:kept])
        if signs is None and np.abs(expected).min() > 1e-6:
            signs = np.sign(white * expected)
        if signs is not None:
            assert np.allclose(white, signs * expected, atol=1e-6)
        assert np.allclose([own[i + 1][0]["explained"] for i in range(kept)], values[:kept] / values.sum(), rtol=1e-6)
    assert {row["n"] for row in rows} == {n}
    assert len({row["identity_error"] for row in rows}) == 1 and rows[0]["identity_error"] < 1e-10


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = op13_whitening(spark, sf_dir)
    assert found.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check(found.collect(), [tuple(row) for row in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()])


def embeddings(spark, *rows):
    return spark.createDataFrame([(key, v, "mine") for key, v in rows], "vec_id long, embedding array<float>, x string").withColumns(
        {c: F.lit("mine") for c in ("key", "component", "n", "deviation", "whitened", "i", "value", "size")}
    )


def test_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    good += [(None, good[0][1]), (1, good[1][1]), (1, good[1][1])]
    odd = [(900, None), (901, []), (902, [None] + [0.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [1.0] * 5), (906, [1e30] * 6)]
    check(whitening.whiten(embeddings(spark, *good, *odd)).collect(), good)


def test_many_equal_rows_count_once(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(i, (rng.normal(size=3) * 10).tolist()) for i in range(500, 900)]
    check(whitening.whiten(embeddings(spark, *rows)).collect(), rows)


def test_dimensions_without_variance(spark):
    """A constant entry and one that is the sum of two others."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        a, b = (rng.integers(-1000, 1000, 2) / 64).tolist()
        rows.append((i, [a, 5.0, b, a + b, float(rng.integers(-9, 9))]))
    check(whitening.whiten(embeddings(spark, *rows)).collect(), rows)
    assert whitening.whiten(embeddings(spark, *[(i, [1.0, 2.0]) for i in range(9)])).collect() == []
    assert whitening.whiten(embeddings(spark, (1, [1.0]))).collect() == []
    assert whitening.whiten(embeddings(spark, (1, None)).limit(0)).collect() == []


@pytest.mark.parametrize("spread", [1.0, 1e-3, 1e-6])
def test_factors_of_ill_conditioned_rows(spread):
    """Q is orthonormal to full precision and Q R gives the rows back, however flat they lie."""
    rng = np.random.default_rng(8)
    n, d = 2000, 12
    rows = rng.normal(size=(n, d)) @ np.diag(spread ** np.linspace(0, 1, d)) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    factors, r = [], np.eye(d)
    for _ in range(whitening.PASSES):
        q = whitening.orthogonal(rows, 1, factors)
        gram = q.T @ q
        factors.append(whitening.cholesky(gram, n, shifted=not factors))
        r = factors[-1] @ r
        if np.abs(gram - np.eye(d)).max() < whitening.NEAR:
            break
    q = whitening.orthogonal(rows, 1, factors)
    assert np.abs(q.T @ q - np.eye(d)).max() < 1e-13
    assert np.abs(q @ r - rows).max() < 1e-12 * np.abs(rows).max()
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(rows)[1], rtol=1e-9)


def test_numbers_beyond_a_long():
    x = np.array([[2**52, -(2**52)], [7, 9]], np.int64)
    sums = np.array([2**52 + 7, 9 - 2**52], object)
    found = whitening.centred(x, 2**20, sums)
    assert found.dtype == object and found[0, 0] == 2**72 - 2**52 - 7
    assert whitening.centred(x, 2, sums).tolist() == [[2**52 - 7, -(2**52) - 9], [7 - 2**52, 9 + 2**52]]

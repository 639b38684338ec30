"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from kerbside.llm import whitening
from kerbside.llm.common import written


def frame(spark, vectors, parts=4):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").repartition(parts)


def plain(vectors):
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    centred = x.astype(float) - np.array([float(s) for s in sums]) / n
    variances, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, variances[::-1], vectors[:, ::-1].T


def check(rows, vectors, components=32):
    n, deviation, centred, variances, axes = plain(vectors)
    kept = min(components, int((np.sqrt(np.maximum(variances, 0)) > 1e-9 * np.sqrt(variances[0])).sum()))
    assert len(rows) == n * kept
    z = np.full((n, kept), np.nan)
    for r in rows:
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert r.explained == pytest.approx(variances[r.component - 1] / variances.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
        z[r.vec_id, r.component - 1] = r.whitened
    wanted = centred @ axes[:kept].T / np.sqrt(variances[:kept])
    signs = np.sign((z * wanted).sum(axis=0))
    assert np.abs(z - signs * wanted).max() < 1e-8


def test_as_a_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 40)) * np.linspace(0.1, 3, 40)
    check(whitening.whiten(frame(spark, vectors.tolist())).collect(), vectors)


def test_fewer_components_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(size=(60, 6)), np.ones((30, 6))])
    check(whitening.whiten(frame(spark, vectors.tolist()), components=3).collect(), vectors, 3)


def test_dependent_dimensions_have_no_component(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-50, 50, size=(80, 3)) / 8
    vectors = np.c_[base, base[:, 0] + base[:, 1], np.full(80, 2.0)]
    check(whitening.whiten(frame(spark, vectors.tolist())).collect(), vectors)


def test_steps_end_early_where_little_variance_is_left():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 30)) * 0.3 ** np.arange(30)
    calls = []

    def product(w):
        calls.append(1)
        p = x @ w
        return p @ x, p @ p

    sigma, vectors = whitening.bidiagonalise(product, 30, (x**2).sum(), 4)
    u, s, v = np.linalg.svd(x)
    assert len(calls) < 30
    assert sigma[:4] == pytest.approx(s[:4], rel=1e-10)
    assert np.abs(np.abs((vectors[:4] * v[:4]).sum(axis=1)) - 1).max() < 1e-10


def test_equal_variances_are_all_found():
    x = np.concatenate([np.eye(8), -np.eye(8)]) * [3, 3, 3, 2, 2, 1, 1, 1]
    sigma, vectors = whitening.bidiagonalise(lambda w: ((x @ w) @ x, (x @ w) @ (x @ w)), 8, (x**2).sum(), 8)
    assert sigma**2 == pytest.approx([18, 18, 18, 8, 8, 2, 2, 2])
    assert np.abs(vectors @ vectors.T - np.eye(8)).max() < 1e-12


def test_unusable_short_and_clashing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 9), (2, None, 9), (3, [1.0, None], 9), (4, [nan, 1.0], 9), (5, [1.0, -inf], 9), (None, [3.0], 9), (7, [], 9), (7, [], 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int")
    out = whitening.whiten(vectors).collect()
    assert sorted({r.vec_id for r in out}, key=str) == [1, 7, None]
    assert len(out) == 4 * 2 and {r.n for r in out} == {4}
    one = [r.deviation for r in out if r.vec_id == 1]
    x = np.array([[64, 128], [192, 0], [0, 0], [0, 0]])
    assert set(one) == {int(((4 * x[0] - x.sum(axis=0)) ** 2).sum())}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]], [None]])
def test_nothing_to_whiten(spark, vectors):
    out = whitening.whiten(frame(spark, vectors))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_sums_beyond_a_long_end_the_job(spark):
    rows = written(whitening.fixed_point(frame(spark, [[1e13, 1.0], [1.0, 2.0]] * 4000)), "large")
    with pytest.raises(OverflowError):
        whitening.fit(rows)

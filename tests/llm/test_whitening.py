"""Whitening against the eigenvectors of the whole covariance."""

import numpy as np
import pytest

from erpspark.llm import whitening as wh
from erpspark.llm.scratch import ship

DDL = "vec_id long, embedding array<float>, label int, x string, key string, i int, block string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return ship(spark).createDataFrame([(i, v, 0, "clash", "clash", 1, "clash") for i, v in zip(ids, vectors, strict=True)], DDL)


def direct(vectors, k=4):
    """n, S, x and the leading eigenpairs from the covariance itself."""
    x = np.array([np.floor(256 * np.array(v, np.float32).astype(float)) for v in vectors]).astype(np.int64)
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    v = c.T @ c / len(fit)
    values, found = np.linalg.eigh(v)
    return x, len(fit), [int(s) for s in fit.sum(axis=0)], values[::-1][:k], found[:, ::-1][:, :k], np.trace(v)


def check(rows, vectors, k=4):
    x, n, sums, values, found, trace = direct(vectors, k)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(by) == len(rows) == len(vectors) * k
    for c in range(k):
        want = (x - np.array(sums) / n) @ found[:, c] / np.sqrt(values[c])
        got = np.array([by[i, c + 1]["whitened"] for i in range(len(vectors))])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
    for (i, c), r in by.items():
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        assert abs(r["explained"] / (values[c - 1] / trace) - 1) < 1e-10
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1


def draw(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return ((rng.standard_normal((n, d)) * np.array(spread)) @ turn + rng.standard_normal(d)).astype(np.float32).tolist()


def test_against_direct(spark):
    vectors = draw(1, 400, 40, np.linspace(1, 2, 40))
    vectors += [vectors[7]] * 300 + [[-0.0] * 40, [0.0] * 40]
    check(wh.whiten(table(spark, vectors)).collect(), vectors)


@pytest.mark.parametrize("spread", [[1, 1e-1, 1e-2, 1e-3] + [1e-4] * 26, [1.0] * 30, [5, 5, 5, 5] + [0.5] * 26])
def test_iteration(spread):
    """Steep, flat and repeated spectra: eigenvalues as the direct ones, vectors with residuals of rounding."""
    x = np.array(draw(2, 500, len(spread), spread), float)
    v = np.cov(x.T, bias=True)
    values, found, residual, _ = wh.leading(lambda y: v @ y, len(v), 4)
    want = np.linalg.eigvalsh(v)[::-1]
    assert residual < 1e-12 and np.allclose(values, want[:4], rtol=1e-9)
    assert np.abs(v @ found - found * values).max() < 1e-12 * want[0] and np.allclose(found.T @ found, np.eye(4), atol=1e-12)


def test_filter_is_the_chebyshev_polynomial():
    values = np.linspace(0.1, 5, 12)
    basis = np.eye(12)
    got = wh.chebyshev(lambda y: values[:, None] * y, basis, values[:, None] * basis, 2.0, 5)
    assert np.allclose(np.diag(got), np.polynomial.chebyshev.Chebyshev.basis(5)(values - 1))
    assert np.abs(np.diag(got)[values <= 2]).max() <= 1 + 1e-9


def test_edges(spark):
    good = draw(3, 30, 3, [1, 2, 3])
    odd = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [], [3e38, 0.0, 0.0]]
    rows = wh.whiten(table(spark, good + odd)).collect()
    check(rows, good, 3)  # three dimensions, three components
    # ids null and repeated; fewer dimensions than entries
    line = [[float(i), 2.0 * i, 0.0, 1.0, 5.0] for i in range(6)]
    rows = wh.whiten(table(spark, line, [None, None, 1, 1, 2, 3])).collect()
    assert [r["component"] for r in rows] == [1] * 6 and sum(r["vec_id"] is None for r in rows) == 2
    assert abs(rows[0]["explained"] - 1) < 1e-9
    assert wh.whiten(table(spark, [[1.0, 2.0]] * 3)).collect() == []
    assert wh.whiten(table(spark, [])).collect() == []
    assert wh.whiten(table(spark, [None, []])).collect() == []


def test_deviation_beyond_a_long():
    x = np.array([[10**9, 0], [3, 4]])
    assert wh.deviations(x, 10**4, [3 * 10**4, 4 * 10**4]) == [None, 0]

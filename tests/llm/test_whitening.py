"""Whitening against numpy's eigenvectors, and the qd solver against its singular values."""

from fractions import Fraction

import numpy as np
import pytest

from tubetrace.llm import whitening

RNG = np.random.default_rng(13)


def turned(values):
    n = len(values)
    q, p = (np.linalg.qr(RNG.standard_normal((n, n)))[0] for _ in range(2))
    return np.linalg.qr(q * np.asarray(values, float) @ p, mode="r")


CASES = {
    "one": np.array([[3.0]]),
    "random": np.linalg.qr(RNG.standard_normal((300, 64)), mode="r"),
    "graded": np.linalg.qr(RNG.standard_normal((90, 30)) * np.logspace(0, -9, 30), mode="r"),
    "diagonal": np.diag(np.arange(1.0, 20)),
    "identity": np.eye(20),
    "equal": turned([3] * 20 + list(np.linspace(1, 2, 20))),
    "close": turned([*(3 + np.arange(20) * 1e-6), *np.linspace(1, 1.00001, 20)]),
    "deficient": np.linalg.qr(np.pad(RNG.standard_normal((50, 6)), ((0, 0), (2, 3))), mode="r"),
}


@pytest.mark.parametrize("case", CASES)
def test_directions(case):
    r = CASES[case]
    squares, rows, total = whitening.whitening_directions(r, 16)
    exact = np.linalg.svd(r, compute_uv=False) ** 2
    rank = int((exact > 1e-24 * exact[0]).sum())
    assert len(squares) == min(16, rank)
    # dqds keeps small values to high relative accuracy where the matrix determines them
    assert squares == pytest.approx(exact[:len(squares)], rel=1e-11 if case != "graded" else 1e-4)
    assert total == pytest.approx(exact.sum(), rel=1e-13)
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-11
    assert np.abs(rows @ (r.T @ r) - squares[:, None] * rows).max() < 1e-13 * exact[0]


def test_dqds_finds_tiny_values_of_a_bidiagonal_matrix():
    # the singular values of a graded bidiagonal matrix are determined to high relative accuracy
    diagonal, above = np.logspace(0, -60, 7), 0.5 * np.logspace(-1, -55, 6)
    values = np.sqrt(whitening.dqds(diagonal, above))
    product = np.prod([Fraction(float(v)) for v in values])
    assert float(product / np.prod([Fraction(float(d)) for d in diagonal])) == pytest.approx(1, rel=1e-13)


def brute(vectors, most):
    """{vec_id: whitened}, explained, sums of squares of the fit list's deviations."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    deviation = ((n * x - sums).astype(object) ** 2).sum(1)
    centred = (n * fit - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, int((e > 1e-12 * e[0]).sum()))
    return ((n * x - sums) / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum(), deviation, n


def vector_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n int")


def test_whitening_of_a_table(spark_llm, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 100)
    vectors = (RNG.standard_normal((300, 20)) * np.linspace(4, .3, 20)).astype(np.float32)
    vectors[50:150] = vectors[7]  # a hot vector
    rows = [(i, v.tolist(), 0, 9) for i, v in enumerate(vectors)]
    bad = [(900, None, 0, 0), (901, [], 0, 0), (902, [None] * 20, 0, 0), (905, [1.0] * 7, 0, 0),
           (903, [float("nan")] + [0.0] * 19, 0, 0), (904, [float("inf")] + [0.0] * 19, 0, 0)]
    table = vector_table(spark_llm, rows + bad).repartition(7)
    got = {(r.vec_id, r.component): r for r in
           whitening.component_rows(whitening.whiten(table)).collect()}
    want, explained, deviation, n = brute(vectors, 16)
    assert len(got) == 300 * 16
    for c in range(16):
        own = np.array([got[i, c + 1].whitened for i in range(300)])
        sign = np.sign(own @ want[:, c])
        assert own == pytest.approx(sign * want[:, c], abs=1e-8)
        assert got[0, c + 1].explained == pytest.approx(explained[c], rel=1e-10)
    assert all(got[i, 1].deviation == deviation[i] and got[i, 1].n == n for i in range(300))
    assert 0 < got[0, 1].identity_error < 1e-10


def test_few_equal_huge_and_no_vectors(spark_llm):
    def whitened(rows):
        return whitening.component_rows(whitening.whiten(vector_table(spark_llm, rows))).collect()

    assert whitened([]) == []
    assert whitened([(1, [1.0, 2.0], 0, 0), (1, [1.0, 2.0], 0, 0)]) == []  # no variance
    assert whitening.whiten(vector_table(spark_llm, [(1, [1.0, 2.0], 0, 0)])).count() == 1
    two = whitened([(1, [1.0, 2.0], 0, 0), (None, [1.5, 2.0], 0, 0), (1, [1.0, 2.0], 0, 0)])
    assert sorted((r.vec_id is None, r.component, round(abs(r.whitened), 9)) for r in two) == [
        (False, 1, 1.0), (False, 1, 1.0), (True, 1, 1.0)]
    assert {r.explained for r in two} == {1.0} and {r.deviation for r in two} == {32 ** 2}
    huge = whitened([(1, [1e30, 0.0], 0, 0), (2, [-1e30, 1.0], 0, 0), (3, [0.0, 1.0], 0, 0)])
    assert len(huge) == 3  # beside 2^62 the other direction has no variance
    assert {r.deviation for r in huge if r.vec_id < 3} == {None}

"""Whitening and FEAST against exact fractions and a dense eigenvalue routine."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from staffcast.llm import whitening


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


SPECTRA = {
    "spread": np.linspace(1, 60, 40),
    "falling": 2.0 ** -np.arange(24),
    "groups": np.repeat([100.0, 99.9999999, 7.0, 7.0 + 1e-9, 1.0, 0.0], 6),
    "equal": np.ones(20),
    "one": np.array([1.0] + [0.0] * 9),
    "small": np.array([3.0, 2.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_largest_eigenpairs(spark, name):
    values = SPECTRA[name]
    matrix = symmetric(values)
    expected = np.sort(values[values > whitening.SMALLEST * values.sum()])[::-1][:16]
    got, vectors = whitening.largest_eigenpairs(spark, matrix, 16)
    assert np.allclose(got, expected, rtol=1e-12, atol=1e-13 * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-11 * values.max()


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia(name):
    values = SPECTRA[name]
    for at in (-1.0, 0.6, 1.7, 6.9, 50.0, 99.99999995, 101.0):
        assert whitening.count_above(symmetric(values), at) == (values > at).sum()
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0) == 1


def test_contour_needs_no_good_first_guess():
    matrix = symmetric(SPECTRA["groups"])
    values, vectors = whitening.feast(matrix, 6.5, 7.5, 12)
    assert len(values) == 12 and np.abs(matrix @ vectors - vectors * values).max() < 1e-11
    with pytest.raises(ArithmeticError):
        whitening.feast(symmetric(SPECTRA["small"]), 10.0, 20.0, 1)


def whole(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def test_rows_equal_exact_numbers(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1 + k) for k in range(6)]) for i in range(120)]
    rows += [(i, list(v)) for i, v in rows[:50]] + [(500 + i, rows[0][1]) for i in range(70)]
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("-inf")] + [0.0] * 5), (None, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows + odd], "vec_id long, v array<double>, kept string, x int").repartition(4)
    out, model = whitening.whiten(df, "v", 4)
    out = out.select("kept.vec_id", "kept.kept", "deviation", "whitened").collect()
    usable = [(i, whole(v)) for i, v in [*rows, odd[-1]]]
    fit = [list(x) for x in {tuple(x) for _, x in usable}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    assert (model["n"], model["sums"]) == (n, sums) and len(out) == len(usable)
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    assert np.allclose(model["values"], values, rtol=1e-12)
    assert np.allclose(model["explained"], values / np.trace(covariance), rtol=1e-12) and model["identity_error"] < 1e-10
    signs = np.sign((vectors * model["vectors"]).sum(0))
    expected = sorted(
        (-1 if i is None else i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)),
         tuple(np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)]) @ vectors / np.sqrt(values) * signs))
        for i, x in usable
    )
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.deviation, tuple(r.whitened)) for r in out)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[2] for g in got], [e[2] for e in expected], atol=1e-9)


@pytest.mark.parametrize("vectors,width", [([], 0), ([[0.5, 1.0]] * 3, 0), ([[]], 0), ([[0.5], [0.5, 2.0], []], 2), ([None], 0)])
def test_few_or_equal_vectors(spark, vectors, width):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    out, model = whitening.whiten(df, "embedding")
    assert len(model["values"]) == width and all(len(r.whitened) == width for r in out.collect())
    assert out.count() == sum(v is not None for v in vectors)


def test_very_large_entries(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [3.0, 3.0])], "vec_id long, embedding array<double>")
    out, model = whitening.whiten(df, "embedding")
    assert {r.deviation for r in out.collect()} == {(1 << 63) - 1} or model["n"] == 3
    assert len(model["values"]) >= 1 and model["identity_error"] < 1e-4

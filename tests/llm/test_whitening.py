"""Whitening against numpy's eigenvectors and whole-number sums."""

from __future__ import annotations

import numpy as np
import pytest

from tarmac.llm import whitening

RNG = np.random.default_rng(13)
SCHEMA = "vec_id long, embedding array<float>, n string, vector string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "n", "v") for i, v in enumerate(vectors)], SCHEMA)


def test_whitening_against_numpy(spark):
    mix = RNG.normal(size=(12, 12)) * np.linspace(3, 0.2, 12)
    good = (RNG.normal(size=(500, 12)) @ mix).astype(np.float32)
    vectors = [*good.tolist(), None, [], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [None] + [0.0] * 11, [1.0] * 5]
    got = whitening.whiten(frame(spark, vectors)).collect()
    x = np.floor(1024 * good.astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    values, parts = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, parts = values[::-1], parts[:, ::-1]
    want = ((x - sums / n) @ parts / np.sqrt(values))[:, :8]
    assert len(got) == n * 8 and {r["n"] for r in got} == {n}
    made = np.zeros((n, 8))
    for r in got:
        made[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r["vec_id"]], sums, strict=True))
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    made *= np.sign((made * want).sum(axis=0))
    assert np.abs(made - want).max() < 1e-8
    assert {r["identity_error"] for r in got}.pop() < 1e-9 and len({r["identity_error"] for r in got}) == 1


def test_factor_and_rotations():
    for width, rank in ((1, 1), (5, 5), (9, 4), (30, 30)):
        low = RNG.normal(size=(width, rank)) * np.logspace(0, -5, rank)
        a = low @ low.T
        order, factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (width, rank) and np.allclose(factor @ factor.T, a[np.ix_(order, order)])
        assert np.allclose(np.triu(factor, 1), 0)
        values, parts = whitening.components(a)
        assert np.allclose(parts.T @ parts, np.eye(rank), atol=1e-9) and (np.diff(values) <= 0).all()
        assert np.allclose(parts * values @ parts.T, a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6)


def test_odd_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [None, [], [float("nan")]])).count() == 0
    # Equal vectors have no direction; two vectors have one.
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 4)).count() == 0
    got = whitening.whiten(frame(spark, [[0.0, 0.0], [0.0, 1.0], [0.0, 1.0], [0.0, 0.0]])).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9), r["explained"]) for r in got) == [(i, 1, 1.0, 1.0) for i in range(4)]
    repeated = frame(spark, [[0.0, 1.0], [2.0, 5.0], [3.0, 0.0]])
    assert whitening.whiten(repeated.union(repeated)).count() == 12


def test_deviations_are_exact_where_they_pass_64_bits():
    x = np.array([[1 << 40, 0], [0, 5]], np.int64)
    n, sums = 7, [12345, 3]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    got = whitening.deviations(x, n, sums)
    assert got == [None if v >= 1 << 63 else v for v in want]
    big = 10_000_000
    got = whitening.deviations(np.array([[300, 100], [0, 1]], np.int64), big, [100 * big + 7, 3])
    assert got == [sum((big * a - s) ** 2 for a, s in zip(row, (100 * big + 7, 3), strict=True)) for row in ([300, 100], [0, 1])]

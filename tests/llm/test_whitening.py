"""Whitening against exact covariances and the definition of an eigenvector in extended precision."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tidemark.llm import whitening


def check_eigen(a, values, x, tolerance=1e-15):
    size = np.abs(a).max()
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(len(a))).max() < 1e-15
    assert np.abs(a.astype(np.longdouble) @ wide - wide * values).max() <= tolerance * size * len(a)
    assert (np.diff(values) <= 1e-15 * size).all()


@pytest.mark.parametrize("spectrum", [
    list(range(1, 41)), [1.0] * 12, [3.0] * 10 + [3 + 1e-9] * 10 + [1e-7] * 5, [10.0**-k for k in range(13)],
    [1e6] * 3 + [1e6 - 1e-4] * 2 + [5.0] * 20 + [0.0] * 6])
def test_eigenvectors_of_clustered_spectra(spectrum):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))
    q = q.astype(np.longdouble)
    q = q + q @ (np.eye(len(q)) - q.T @ q) / 2
    a = (q * np.array(spectrum, dtype=np.longdouble)) @ q.T
    a = (a + a.T) / 2
    values, x = whitening.eigen(a)
    check_eigen(a, values, x)
    assert np.allclose(values, sorted(spectrum, reverse=True), rtol=0, atol=1e-15 * max(spectrum))


def test_better_than_the_float32_start():
    rng = np.random.default_rng(1)
    b = rng.normal(size=(50, 200)).astype(np.longdouble)
    a = b @ b.T / 200
    values, x = whitening.eigen(a)
    check_eigen(a, values, x)
    reference = np.linalg.eigh(a.astype(np.float64))[1][:, ::-1]
    assert np.abs(np.abs(x) - np.abs(reference)).max() < 1e-11
    start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs(start) - np.abs(reference)).max() > 1e-7


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from([1, 3, 50]))
def test_eigenvectors_of_integer_matrices(d, seed, most):
    b = np.random.default_rng(seed).integers(-most, most + 1, size=(d, d))
    a = (b @ b.T).astype(np.longdouble)  # often singular or with equal eigenvalues
    values, x = whitening.eigen(a)
    if a.any():
        check_eigen(a, values, x)


def expected(vectors, components=32, scale=64, offset=1_000_000):
    """Exact integers and covariance, by fractions."""
    x = [[math.floor(scale * float(np.float32(c))) + offset for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = [[Fraction(n * r[j] - sums[j], n) for j in range(d)] for r in x]
    v = [[sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return n, deviation, np.array([[float(c) for c in r] for r in centred]), np.array([[float(c) for c in r] for r in v])


SCHEMA = "vec_id long, embedding array<float>, label int, i int, row string, n int, whitened string, deviation string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "r", 3, "w", "d") for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(60, 7)) * [3, 3, 1, 0.5, 0.2, 2, 1]).tolist()
    out = [(k, v) for k, v in enumerate(vectors)]
    out += [(100, vectors[0]), (5, vectors[5]), (None, vectors[7])]                      # equal vectors, repeated row, null id
    out += [(200, None), (201, [1.0, None] + [0.0] * 5), (202, [float("nan")] + [0.0] * 6),
            (203, [float("-inf")] + [0.0] * 6), (204, []), (205, [1.0, 2.0])]            # take no part
    return out


def test_whitened_rows(workers, rows):
    whole = [(i, v) for i, v in rows if i is None or i < 200]
    n, deviation, centred, covariance = expected([v for _, v in whole])
    found = whitening.whiten(frame(workers, rows).repartition(3)).collect()
    assert len(found) == n == 63 and {r.n for r in found} == {n}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.vec_id, r.deviation) for r in found), key=key) == sorted(
        zip([i for i, _ in whole], deviation), key=key)
    values, x = np.linalg.eigh(covariance)
    values, x = values[::-1], x[:, ::-1]
    plain = {(i, d): c @ x / np.sqrt(values) for (i, _), d, c in zip(whole, deviation, centred)}
    w = np.array([r.whitened for r in found])
    p = np.array([plain[r.vec_id, r.deviation] for r in found])
    assert np.abs(np.abs(w) - np.abs(p)).max() < 1e-10
    assert all((np.sign(w[:, k]) == np.sign(p[:, k])).all() or (np.sign(w[:, k]) == -np.sign(p[:, k])).all() for k in range(7))
    assert np.abs(w.T @ w / n - np.eye(7)).max() < 1e-12
    assert np.allclose(found[0].explained, values / np.trace(covariance), rtol=1e-12)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-12


def test_fewer_components_and_dependent_dimensions(workers):
    rng = np.random.default_rng(2)
    base = np.round(rng.normal(size=(40, 3)) * 64) / 64
    vectors = np.hstack([base, base[:, :1] * 0, base * 2])    # a constant and three dependent ones
    df = frame(workers, [(k, v.tolist()) for k, v in enumerate(vectors)])
    found = whitening.whiten(df).collect()
    assert {len(r.whitened) for r in found} == {3} and found[0].identity_error < 1e-10
    assert abs(sum(found[0].explained) - 1) < 1e-12
    assert {len(r.whitened) for r in whitening.whiten(df, components=2).collect()} == {2}


def test_one_row_and_no_rows(workers):
    one = whitening.whiten(frame(workers, [(1, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened) for r in one] == [(1, 1, 0, [])]
    assert whitening.whiten(frame(workers, [(1, None)])).collect() == []
    assert whitening.whiten(frame(workers, [])).collect() == []


def test_deviation_beyond_a_long_is_null(workers):
    found = whitening.whiten(frame(workers, [(1, [1e12]), (2, [-1e12]), (3, [0.0])])).collect()
    assert {r.vec_id: r.deviation for r in found}[1] is None
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(workers, [(1, [1e30]), (2, [1.0])])).collect()


def test_registered_query(workers):
    from tidemark.llm import queries

    rows = workers.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(np.array([r.embedding for r in rows], dtype=np.float64) * 64) + 1_000_000
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    plain = {r.vec_id: c @ vectors / np.sqrt(values) for r, c in zip(rows, centred)}
    found = queries.queries()["op13_whitening"](workers, SF001).collect()
    assert len(found) == 32 * len(rows) and {r.component for r in found} == set(range(1, 33))
    assert max(abs(abs(r.whitened) - abs(plain[r.vec_id][r.component - 1])) for r in found) < 1e-8
    assert max(abs(r.explained / (values[r.component - 1] / np.trace(covariance)) - 1) for r in found) < 1e-10
    assert max(r.identity_error for r in found) < 1e-10

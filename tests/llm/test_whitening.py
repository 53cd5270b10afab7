"""Whitening against numpy's eigendecomposition, and the slicing against it on hard spectra."""

import math

import numpy as np
import pytest

from strideframe.llm import whitening as W
from strideframe.llm.queries import QUERIES
from strideframe.llm.spectrum import factor, leading_pairs


def _matrix(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", range(6))
def test_leading_pairs(kind):
    rng = np.random.default_rng(kind)
    for _ in range(12):
        d = int(rng.integers(1, 30))
        values = (
            rng.random(d), 10.0 ** rng.uniform(-8, 8, d), np.repeat(rng.random(d), 3)[:d], np.where(rng.random(d) < 0.5, 0, rng.random(d)),
            1 + 1e-9 * rng.random(d), rng.normal(size=d),
        )[kind]
        a = _matrix(rng, values)
        got, vectors = leading_pairs(a, 16)
        size = np.abs(a).sum()
        assert np.abs(got - np.sort(np.linalg.eigvalsh(a))[::-1][:16]).max() <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
        assert np.abs(a @ vectors - vectors * got).max() <= 1e-12 * size


def test_inertia_and_solve():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a = _matrix(rng, rng.normal(size=int(rng.integers(1, 20))))
        values = np.linalg.eigvalsh(a)
        shift = float(rng.normal())
        parts = factor(a, shift, 1e-300)
        assert parts.above == (values > shift).sum()
        right = rng.normal(size=len(a))
        assert np.abs((a - shift * np.eye(len(a))) @ parts.solve(right) - right).max() < 1e-8


def _plain(rows, components=16):
    """(n, S, x-vectors by row, eigenvalues, eigenvectors) by numpy."""
    x = {k: np.array([math.floor(64 * c) + 1_000_000 for c in v], object) for k, v in enumerate(rows)}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, sums = len(fit), fit.sum(0)
    centred = (fit - sums / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, x, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()


def test_query_against_numpy(spark, sf_dir):
    source = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    ids = list(source)
    n, sums, x, values, vectors, trace = _plain([source[i] for i in ids])
    got = {(r["vec_id"], r["component"]): r for r in QUERIES["op11_embedding_whitening"](spark, sf_dir).collect()}
    assert len(got) == 16 * len(ids)
    white = np.array([[got[i, k]["whitened"] for k in range(1, 17)] for i in ids])
    want = np.array([(x[k] - sums / n).astype(float) for k in range(len(ids))]) @ vectors / np.sqrt(values)
    assert np.abs(white - want * np.sign((white * want).sum(0))).max() < 1e-7
    for k, i in enumerate(ids):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * v - s) ** 2 for v, s in zip(x[k], sums))
    for k in range(16):
        assert abs(got[ids[0], k + 1]["explained"] / (values[k] / trace) - 1) < 1e-9
    assert max(r["identity_error"] for r in got.values()) < 1e-9


def test_copies_count_once_and_bad_rows_take_no_part(frame):
    rng = np.random.default_rng(5)
    good = [rng.normal(size=3).tolist() for _ in range(30)]
    rows = [(k, v, 1.0) for k, v in enumerate(good)] + [(100 + k, good[0], 2.0) for k in range(50)] + [(None, good[1], 1.0)]
    bad = [(200, None, 1.0), (201, [1.0, None, 2.0], 1.0), (202, [1.0, float("nan"), 2.0], 1.0), (203, [1.0, float("inf"), 2.0], 1.0),
           (204, [1.0, 1e308, 2.0], 1.0), (205, [], 1.0)]
    docs = frame(rows + bad, "vec_id long, embedding array<double>, n double")
    got = W.whiten(docs).collect()
    n, sums, x, values, vectors, _ = _plain(good, 3)
    assert len(got) == 3 * len(rows) and {r["n"] for r in got} == {n}
    assert {r["vec_id"] for r in got} == {r[0] for r in rows}
    first = {r["component"]: r["whitened"] for r in got if r["vec_id"] == 0}
    assert all({r["component"]: r["whitened"] for r in got if r["vec_id"] == 100 + k} == first for k in range(50))
    want = (x[0] - sums / n).astype(float) @ vectors / np.sqrt(values)
    assert np.allclose(np.abs(want), [abs(first[k]) for k in (1, 2, 3)], atol=1e-9)


def test_lengths_are_fitted_apart(frame, spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [5.0]), (5, [7.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0])]
    got = W.whiten(frame(rows, "vec_id long, embedding array<float>")).collect()
    by_row = {(r["vec_id"], r["component"]): r for r in got}
    assert {k: v["n"] for k, v in by_row.items()} == {(1, 1): 3, (1, 2): 3, (2, 1): 3, (2, 2): 3, (3, 1): 3, (3, 2): 3, (4, 1): 2, (5, 1): 2} | {
        (i, k): 1 for i in (6, 7) for k in (1, 2, 3)
    }
    assert sorted(round(by_row[i, 1]["whitened"], 9) for i in (4, 5)) == [-1.0, 1.0]
    assert all(by_row[6, k]["whitened"] is None and by_row[6, k]["explained"] is None for k in (1, 2, 3))
    assert by_row[6, 1]["deviation"] == 0 and by_row[4, 1]["deviation"] == (2 * 64 - 64 * 4) ** 2
    assert W.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_wide_values_are_exact(frame):
    rng = np.random.default_rng(9)
    rows = [(k, [float(v) for v in rng.integers(-(1 << 33), 1 << 33, 4)]) for k in range(40)]
    got = {(r["vec_id"], r["component"]): r for r in W.whiten(frame(rows, "vec_id long, embedding array<double>")).collect()}
    n, sums, x, values, vectors, trace = _plain([v for _, v in rows], 4)
    for k in range(40):
        exact = sum((n * v - s) ** 2 for v, s in zip(x[k], sums))
        assert got[k, 1]["deviation"] == (exact if exact < 1 << 63 else None)
    assert all(abs(got[0, k + 1]["explained"] / (values[k] / trace) - 1) < 1e-9 for k in range(4))
    assert got[0, 1]["identity_error"] < 1e-9


def test_long_vectors(frame):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=300).tolist()) for k in range(40)]
    got = W.whiten(frame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 40 * 16 and got[0]["identity_error"] < 1e-6

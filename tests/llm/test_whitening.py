"""Whitening against a dense eigensolver, and the eigensolver on hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest
from text_helpers import SF

from adlytics.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, x string, component string, n string"


def whole_rows(rows):
    out = []
    for vec_id, vector in rows:
        if vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        out.append((vec_id, tuple(math.floor(64 * c) + 1_000_000 for c in vector)))
    return out


def brute(rows, components=16):
    rows = whole_rows(rows)
    fitted = np.array(sorted({x for _, x in rows}), object)
    n, sums = len(fitted), fitted.sum(axis=0)
    c = ((n * fitted - sums) / n).astype(float)
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for vec_id, x in rows:
        exact = n * np.array(x, object) - sums
        white = (exact / n).astype(float) @ vectors / np.sqrt(np.maximum(values, 1e-300))
        for k in range(min(components, len(values))):
            out.setdefault((vec_id, k + 1), []).append((n, int((exact**2).sum()), white[k], values[k] / np.trace(v)))
    return out


def check(got, rows, components=16):
    want = brute(rows, components)
    have = {}
    for r in got:
        have.setdefault((r.vec_id, r.component), []).append(r)
    assert have.keys() == want.keys()
    signs = {}
    for (_, k), found in sorted(have.items(), key=str):
        key = [r for r in found if abs(r.whitened) > 0.1]
        if k not in signs and key:
            other = min(want[(key[0].vec_id, k)], key=lambda w: abs(abs(w[2]) - abs(key[0].whitened)))
            signs[k] = 1 if (other[2] > 0) == (key[0].whitened > 0) else -1
    for (vec_id, k), found in have.items():
        expected = sorted((n, d, signs.get(k, 1) * w, e) for n, d, w, e in want[(vec_id, k)])
        assert len(found) == len(expected)
        for r, (n, d, w, e) in zip(sorted(found, key=lambda r: (r.n, r.deviation, r.whitened)), expected):
            assert (r.n, r.deviation) == (n, d)
            assert r.whitened == pytest.approx(w, abs=1e-7) and r.explained == pytest.approx(e, rel=1e-10)
            assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)


def test_query(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = queries.op13_whitening(spark, SF).collect()
    assert len(got) == 16 * len(rows)
    check(got, rows)


def test_copies_ties_and_left_out_rows(spark):
    rng = np.random.default_rng(1)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(c) for c in rng.standard_normal(4) * [3, 2, 1, 0.2]]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [rows[1], rows[1], (None, rows[2][1])]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0]), (202, [nan, 0.0, 0.0, 0.0]), (203, [0.0, -inf, 0.0, 0.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    check(got, rows)
    assert not {200, 201, 202, 203} & {r.vec_id for r in got}


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(2)
    short = [(i, [float(c) for c in rng.standard_normal(2)]) for i in range(30)]
    long = [(100 + i, [float(c) for c in rng.standard_normal(5)]) for i in range(50)]
    got = whitening.whiten(table(spark, short + long + [(500, []), (501, [1.0] * 7)]), 3).collect()
    check([r for r in got if r.vec_id < 100], short, 3)
    check([r for r in got if 100 <= r.vec_id < 500], long, 3)
    # One vector has no variance, an empty one no direction.
    assert not [r for r in got if r.vec_id >= 500]


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), float(2 * a), 5.0, float(b)]) for i, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)))]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, rows, 2)


def test_no_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, [2.0]), (2, [2.0])])).collect() == []


def test_deviations_beyond_a_long(spark):
    rows = [(i, [float(v), 0.5 * i]) for i, v in enumerate([2.0**40, -(2.0**40), 3.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows), 1).collect()}
    assert got[0] is None and got[1] is None
    small = [(i, [v, 0.5 * i]) for i, (_, (v, _)) in enumerate(rows[2:] * 2)]
    assert all(r.deviation is not None for r in whitening.whiten(table(spark, small), 1).collect())


def matrices():
    rng = np.random.default_rng(0)
    turned = lambda values: (lambda q: q * values @ q.T)(np.linalg.qr(rng.standard_normal((len(values),) * 2))[0])
    yield "random", (lambda a: a @ a.T)(rng.standard_normal((48, 100)))
    yield "one", np.array([[3.0]])
    yield "zero", np.zeros((7, 7))
    yield "equal", 2.5 * np.eye(9)
    yield "diagonal", np.diag(np.arange(20.0))
    yield "repeated", turned(np.repeat([5.0, 3.0, 1.0, 1e-3], 6))
    yield "rank", (lambda a: a @ a.T)(rng.standard_normal((30, 3)))
    yield "wide", turned(10.0 ** np.arange(0, -14, -1))
    yield "close", turned(1.0 + np.arange(12) * 1e-9)
    yield "offset", 1e6 + (lambda a: a @ a.T)(rng.standard_normal((20, 40)))


@pytest.mark.parametrize("name,v", list(matrices()))
def test_spectrum(name, v):
    v = (v + v.T) / 2
    values, vectors = whitening.spectrum(v)
    size = max(float(np.linalg.norm(v)), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(v))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * size


def test_polar_factor_is_orthogonal_and_commutes():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((25, 25))
    a = a + a.T
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(25)).max() < 1e-12
    assert np.abs(u @ a - a @ u).max() < 1e-11
    assert (np.linalg.eigvalsh(u @ a) > 0).all()

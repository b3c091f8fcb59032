"""Exact top-k products against every pair."""

from __future__ import annotations

import math

import numpy as np
import pytest
from text_helpers import SF

from adlytics.llm import pivot_search, queries

SCHEMA = "vec_id long, embedding array<double>, label int, x string, row string"


def brute(rows, every, k, scale=256):
    """rows: (vec_id, vector)."""
    valid = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        valid.append((vec_id, [math.floor(c * scale) for c in vector]))
    out = []
    for at, (vec_id, x) in enumerate(valid):
        if vec_id % every:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(x, y)), other)
            for i, (other, y) in enumerate(valid)
            if i != at and len(y) == len(x)
        )
        out += [(vec_id, r + 1, other, -s) for r, (s, other) in enumerate(scores[:k])]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], SCHEMA)


def test_query(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(queries.op12_pivot_search(spark, SF)) == brute(rows, 50, 5)


SMALL = dict(cell_rows=8, block_rows=5, query_rows=3, round_rows=(10, 40))


@pytest.mark.parametrize("seed", range(4))
def test_many_annuli_blocks_and_rounds(seed, spark):
    """Clusters of all sizes, ties, copies, negative and large products."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 5)) * [1, 1, 10, 0.1, 100][seed]
    rows = []
    for i in range(300):
        v = centres[rng.integers(6)] + rng.standard_normal(5) * rng.choice([0.0, 0.1, 1.0])
        rows.append((int(rng.integers(0, 200)), [float(c) for c in np.round(v, 1)]))
    got = pivot_search.top_products(table(spark, rows), 10, 4, **SMALL)
    assert found(got) == brute(rows, 10, 4)


def test_copies(spark):
    """A third of all rows one vector, another group of zero vectors."""
    rng = np.random.default_rng(9)
    rows = [(i, [0.5, 0.5, 0.0]) for i in range(0, 240, 2)]
    rows += [(i, [0.0, 0.0, 0.0]) for i in range(1, 120, 2)]
    rows += [(1000 + i, [float(c) for c in rng.standard_normal(3)]) for i in range(100)]
    got = pivot_search.top_products(table(spark, rows), 10, 5, **SMALL)
    assert found(got) == brute(rows, 10, 5)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 2.0]), (10, [3.0]), (20, [4.0]), (30, []),
        (40, []), (50, None), (60, [1.0, None]), (70, [1.0, nan]), (80, [inf, 1.0]),
        (None, [1.0, 2.0]), (90, [1.0, 2.0, 3.0]), (1, [0.001, -0.001]), (2, [1e4, -1e4]), (100, [0.0, 0.0]),
    ]
    got = pivot_search.top_products(table(spark, rows), 10, 5)
    assert found(got) == brute(rows, 10, 5)


def test_products_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.integers(-(2**21), 2**21, 3)]) for i in range(120)]
    rows += [(200 + i, [rows[0][1][0] + i / 256, *rows[0][1][1:]]) for i in range(8)]
    want = brute(rows, 10, 5)
    assert any(s > 2**53 for *_, s in want)
    assert found(pivot_search.top_products(table(spark, rows), 10, 5, **SMALL)) == want


def test_products_beyond_a_long_raise(spark):
    df = table(spark, [(0, [1e10, 1.0]), (1, [1.0, 1.0])])
    with pytest.raises(ValueError, match="do not fit"):
        pivot_search.top_products(df, 10, 5)


def test_no_rows(spark):
    assert found(pivot_search.top_products(table(spark, []), 10, 5)) == []
    assert found(pivot_search.top_products(table(spark, [(5, [1.0])]), 10, 5)) == []


def test_bounds_stop_the_search():
    """Annuli beyond the worst answer are not visited, and none with an answer is left out."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 8)) * 1000
    x = centres[rng.integers(40, size=8000)] + rng.standard_normal((8000, 8)) * 20
    x = (x / np.linalg.norm(x, axis=1)[:, None] * 1000).astype(np.int64)
    longest = float((x.astype(float) ** 2).sum(axis=1).max())
    layout = pivot_search.Layout(x[:2000], longest, 160)
    cell, distance = layout.place(x)
    layout.describe(
        [(int(c), int((cell == c).sum()), distance[cell == c].min(), distance[cell == c].max()) for c in np.unique(cell)]
    )
    q = x[::100]
    products = pivot_search.products(q, x)
    worst = np.sort(products, axis=1)[:, -6]
    visited = layout.bounds(q) <= layout.reach(q, worst)[:, None]
    column = {c: i for i, c in enumerate(layout.cells.tolist())}
    for i in range(len(q)):
        for j in np.flatnonzero(products[i] >= worst[i]):
            assert visited[i, column[int(cell[j])]]
    assert (visited * layout.rows).sum() < 0.2 * len(q) * len(x)

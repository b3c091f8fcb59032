"""Nearest neighbours: recall against brute force, exact scores, awkward vectors."""

from __future__ import annotations

import numpy as np
import pytest

from adlytics.llm import projected_search as search

SF = "/root/testdata/sf0.01"


def brute(rows, every, k):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None for x in vector):
            continue
        own = np.array(vector, float)
        if np.isfinite(own).all() and own.any():
            usable.setdefault((vec_id, tuple(own)), own)
    queries = {}
    for (vec_id, key), own in usable.items():
        if vec_id % every == 0 and (vec_id not in queries or list(key) < list(queries[vec_id])):
            queries[vec_id] = own
    out = {}
    for query_id, query in queries.items():
        best = {}
        for (vec_id, _), own in usable.items():
            if vec_id != query_id and len(own) == len(query):
                far = float(np.sqrt(((own - query) ** 2).sum()))
                best[vec_id] = min(best.get(vec_id, np.inf), far)
        out[query_id] = sorted((far, i) for i, far in best.items())[:k]
    return out


def compare(df, every, k, recall):
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], every, k)
    got = {}
    for r in search.nearest(df, every, k).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(got) == {q for q in want if want[q]}
    hit = total = 0
    for query_id, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(want[query_id]) + 1))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
        hit += len({i for _, _, i in own} & {i for _, i in want[query_id]})
        total += len(own)
        exact = dict((i, f) for f, i in want[query_id])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, s, i in own if i in exact)
    assert hit >= recall * total
    return got


@pytest.mark.parametrize("block", [16_384, 60])
def test_recall(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_ROWS", block)
    monkeypatch.setattr(search, "QUERY_ROWS", 3)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    compare(df, 20, 10, 0.9)


def test_cells_are_bounded_and_lose_nothing(spark, monkeypatch):
    """Few cells of many blocks each: what all tasks hold does not grow with the vectors."""
    monkeypatch.setattr(search, "BLOCK_ROWS", 20)
    monkeypatch.setattr(search, "MAX_CELLS", 4)
    monkeypatch.setattr(search, "QUERY_ROWS", 7)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    compare(df, 20, 10, 0.9)


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ROWS", 8)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 7), 2.0]) for i in range(60)]
    rows += [(100, None), (110, [0.0, 0.0, 0.0]), (120, [1.0, None, 1.0]), (130, [nan, 1.0, 1.0])]
    rows += [(140, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (150, [1.0, 2.0]), (160, [1.0, 3.0])]
    rows += [(0, [1.0, 0.0, 2.0]), (10, [5.0, 5.0, 5.0]), (170, [])]
    schema = "vec_id long, embedding array<float>, label int, dim string, cell string"
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], schema)
    got = compare(df, 10, 5, 1.0)
    assert [i for _, _, i in got[0]] == [7, 14, 21, 28, 35]
    assert [i for _, _, i in got[150]] == [160]
    assert search.nearest(df.limit(0), 10, 5).count() == 0


@pytest.mark.parametrize("block", [16_384, 60])
def test_ties_of_many_copies_go_to_the_smallest_ids(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_ROWS", block)
    monkeypatch.setattr(search, "LEAF_ROWS", 16)
    rng = np.random.default_rng(3)
    twin, other, *single = rng.standard_normal((202, 24)).tolist()
    vectors = [twin] * 300 + [other] * 100 + single
    # A query beside each group has no copy of its own, only a group at one distance.
    vectors += [[x + 0.01 for x in v] for v in (twin, other)]
    ids = [int(i) * 10 for i in rng.permutation(len(vectors))]
    df = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 10, 10)
    got = {}
    for r in search.nearest(df.repartition(7), 10, 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert len(got) == len(vectors)
    for query_id in ids[:400] + ids[-2:]:
        assert [i for _, i in sorted(got[query_id])] == [i for _, i in want[query_id]]


def test_copies_that_differ_in_the_sign_of_zero(spark):
    rows = [(i, [0.0 if i % 2 else -0.0, 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = search.nearest(df, 39, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [
        (0, 1), (0, 2), (0, 3), (39, 0), (39, 1), (39, 2),
    ]


def test_equal_vectors_have_equal_projections_in_any_batch():
    vectors = np.random.default_rng(5).standard_normal((37, 65))
    whole = search.project_rows(vectors)
    for n in (1, 2, 3, 8, 36):
        assert (search.project_rows(vectors[:n]) == whole[:n]).all()


def test_chi_square():
    assert search.chi_square(7.344, 8) == pytest.approx(0.5, abs=1e-3)
    assert search.chi_square_point(0.95) == pytest.approx(15.507, abs=1e-2)

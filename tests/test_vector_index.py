"""Nearest vectors against comparing all of them."""

import numpy as np
import pytest

from gaugeline.operators import vector_index as vi


def brute(vectors, queries, k):
    known = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors if i is not None and v is not None and np.linalg.norm(v) > 0}
    out = {}
    for i, v in queries:
        if v is None or np.linalg.norm(v) == 0:
            continue
        u = np.array(v) / np.linalg.norm(v)
        sims = sorted((-round(float(u @ w), 9) + 0.0, j) for j, w in known.items() if j != i)
        out[i] = [(j, pytest.approx(-s, abs=1e-8)) for s, j in sims[:k]]
    return {i: x for i, x in out.items() if x}


def run(spark, vectors, queries, k, **more):
    kind = "id int, e array<double>, rank int"
    v, q = (spark.createDataFrame([(i, None if x is None else [float(y) for y in x], 1) for i, x in rows], kind) for rows in (vectors, queries))
    got = {}
    for r in vi.nearest_vectors(v, q, "id", "e", k, **more).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], r["similarity"]))
        assert r["rank"] == len(got[r["id"]])
    return got


@pytest.mark.parametrize("more", [{}, {"cells": 60, "rows": 7}])
def test_all_neighbours(spark, more):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(12, 6)) * 3
    vectors = [(i, middles[i % 12] + rng.normal(size=6) * 0.3) for i in range(600)]
    vectors += [(1000 + i, middles[0]) for i in range(150)]  # a group of copies
    vectors += [(2000, None), (2001, np.zeros(6)), (None, middles[1]), (2002, -middles[0])]
    queries = [r for r in vectors if r[0] is not None and r[0] % 20 == 0] + [(5000, rng.normal(size=6)), (1001, middles[0])]
    assert run(spark, vectors, queries, 5, **more) == brute(vectors, queries, 5)


def test_fewer_rows_than_neighbours(spark):
    vectors = [(1, [1, 0]), (2, [1, 1]), (3, [2, 2])]
    assert run(spark, vectors, vectors, 5) == brute(vectors, vectors, 5)
    assert run(spark, [(1, None)], vectors, 5) == {} and run(spark, vectors, [(1, None)], 5) == {}


def test_far_cells_are_skipped():
    rng = np.random.default_rng(2)
    centres = np.eye(8)
    x = np.repeat(centres, 50, axis=0) + rng.normal(size=(400, 8)) * 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    opener = vi._opener(centres, np.full(8, 50), np.full(8, 0.1), 5, vi._matrix, vi._distances, np, vi.pa, vi.SLACK)
    vectors = vi.pa.array([list(v) for v in x[:3]], vi.pa.list_(vi.pa.float64()))
    for bound, want in ((None, 1), (0.05, 0), (2.0, 7)):
        batch = vi.pa.record_batch({"__q": vi.pa.array([1, 2, 3]), "__v": vectors, "__bound": vi.pa.array([bound] * 3, vi.pa.float64())})
        assert sum(len(b) for b in opener([batch])) == 3 * want

"""Neighbours on a map against measuring every distance."""

import numpy as np
import pytest

from gaugeline.operators import nearest as nb


def brute(queries, points, k):
    out = {}
    for key, qx, qy in queries:
        d = sorted(((qx - x) ** 2 + (qy - y) ** 2, ok) for x, y, ok in points)
        if d:
            kth = d[min(k, len(d)) - 1][0]
            near = [ok for d2, ok in d if d2 <= kth]
            out[key] = (len(near), sum(near) / len(near), kth ** 0.5)
    return out


def run(spark, queries, points, k):
    p = spark.createDataFrame([(float(x), float(y), ok, 7) for x, y, ok in points], "px double, py double, ok int, n int")
    q = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in queries], "id int, x double, y double")
    return {r["id"]: (r["neighbours"], pytest.approx(r["accuracy"]), pytest.approx(r["radius"])) for r in nb.competence_surface(p, "px", "py", "ok", q, "id", k).collect()}


def cloud(n, seed=1):
    rng = np.random.default_rng(seed)
    return [(round(x, 3), round(y, 3), int(o)) for x, y, o in zip(rng.random(n), rng.random(n), rng.integers(0, 2, n))]


@pytest.mark.parametrize("k", [1, 7, 40])
def test_spread_points(spark, k):
    points, queries = cloud(500), [(i, x, y) for i, (x, y, _) in enumerate(cloud(40, 2))]
    assert run(spark, queries, points, k) == brute(queries, points, k)


def test_dense_spot_far_points_and_empty_parts(spark):
    """A third of the points at one place, a dense cluster, a far point, queries outside of the box."""
    rng = np.random.default_rng(3)
    points = [(0.5, 0.5, i % 2) for i in range(300)] + [(0.9 + x / 1000, 0.9 + y / 1000, 1) for x, y in rng.random((500, 2))] + cloud(60, 5) + [(-40.0, 3.0, 0)]
    queries = [(0, 0.5, 0.5), (1, 0.51, 0.5), (2, 0.9, 0.9), (3, -39.0, 0.0), (4, 100.0, 100.0), (5, 0.0, 1.0), (6, -100.0, -7.0)]
    assert run(spark, queries, points, 15) == brute(queries, points, 15)


def test_ties_all_count(spark):
    points = [(x, y, 1) for x in range(9) for y in range(9)]
    queries = [(0, 4, 4), (1, 0, 0), (2, 4.5, 4.5)]
    assert run(spark, queries, points, 3) == brute(queries, points, 3)
    assert run(spark, queries, points, 3)[0][0] == 5


def test_no_pairs_beyond_what_the_distance_reaches(spark):
    rng = np.random.default_rng(8)
    points = spark.createDataFrame([(float(x), float(y), 1) for x, y in rng.random((4000, 2))], "x double, y double, n int")
    queries = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((50, 2)))], "id int, x double, y double")
    pairs = nb.knn_pairs(queries, points, "id", "x", "y", 10)
    assert pairs.count() == 500
    # the join on the finest cells is what pairs rows
    placed, levels, _ = nb.pyramid(points, "x", "y", 10)
    assert len(levels) == 6 and levels[-1].count() > 300 and placed.count() == 4000


def test_nulls_and_too_few(spark):
    p = spark.createDataFrame([(0.0, 0.0, 1), (None, 1.0, 1), (1.0, None, 0), (1.0, 1.0, None), (1.0, 0.0, 0)], "px double, py double, ok int")
    q = spark.createDataFrame([(1, 0.2, 0.0), (2, None, 0.0)], "id int, x double, y double")
    rows = nb.competence_surface(p, "px", "py", "ok", q, "id", 15).collect()
    assert [(r["id"], r["neighbours"], r["accuracy"]) for r in rows] == [(1, 2, 0.5)]
    assert nb.competence_surface(p.limit(0), "px", "py", "ok", q, "id", 15).collect() == []

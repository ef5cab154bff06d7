"""Order statistics against sorting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import comparison as co
from gaugeline.operators.selection import floor_rank, order_statistics, quantiles

RANKS = {"first": 0, "p5": floor_rank(0.05), "mid": floor_rank(0.5), "p95": floor_rank(0.95), "last": lambda n: n - 1, "beyond": 10**9}


def frame(spark, rows):
    return spark.createDataFrame([(g, None if v is None else float(v), w) for g, v, w in rows], "g string, v double, w int")


def want(rows):
    out = {}
    for g in {g for g, v, w in rows if v is not None and w}:
        vals = sorted((v for h, v, w in rows if h == g and v is not None for _ in range(w)), key=lambda v: (math.isnan(v), v))
        n = len(vals)
        out[g] = tuple(vals[r] if 0 <= r < n else None for r in (0, int(0.05 * n), int(0.5 * n), int(0.95 * n), n - 1, 10**9))
    return out


def got(df, **more):
    return {r["g"]: tuple(r)[1:] for r in order_statistics(df, ["g"], "v", RANKS, "w", **more).collect()}


def draws(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [("normal", x, 1) for x in rng.normal(0, 3, n)] + [("one value", 2.5, 1)] * n
    rows += [("hot", 7.0, 1)] * n + [("hot", x, int(w)) for x, w in zip(rng.random(n), rng.integers(0, 4, n))]
    rows += [("scales", 10.0 ** e * s, 1) for e in range(-300, 301, 3) for s in (1, -1)]
    return rows + [("tiny", 1.0, 1), ("tiny", None, 1), (None, 4.0, 2), (None, -4.0, 1), ("gone", None, 1)]


@pytest.mark.parametrize("limits", [{}, {"small": 40, "bins": 64}])
def test_many_groups_and_ranks(spark, limits):
    rows = draws(120)
    assert got(frame(spark, rows).repartition(3), **limits) == want(rows)


def test_many_distinct_values_take_two_refinements(spark):
    df = spark.range(60_000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("v"))
    r = order_statistics(df, [], "v", {"mid": floor_rank(0.5), "p1": floor_rank(0.01)}, small=500, bins=64).first()
    vals = sorted(x["v"] for x in df.collect())
    assert (r["mid"], r["p1"]) == (vals[30_000], vals[600])


def test_neighbouring_and_extreme_numbers(spark):
    close = [np.nextafter(1.0, 2.0), 1.0, np.nextafter(1.0, 0.0)]
    rows = [("a", v, 1) for v in close * 5] + [("b", v, 1) for v in (1.7e308, -1.7e308, 0.0, 5e-324, -5e-324) * 4]
    assert got(frame(spark, rows), small=3, bins=64) == want(rows)


def test_not_a_number_is_the_largest(spark):
    rows = [("a", v, 1) for v in (1.0, math.nan, 3.0, math.nan)]
    r = order_statistics(frame(spark, rows), ["g"], "v", {"a": 1, "b": 2}).first()
    assert r["a"] == 3.0 and math.isnan(r["b"])


def test_quantiles_are_interpolated(spark):
    rng = np.random.default_rng(2)
    vals = rng.normal(size=501)
    df = frame(spark, [(g, v, 1) for g in ("x", None) for v in vals])
    for r in quantiles(df, ["g"], "v", {"q1": 0.1, "q2": 0.5, "q3": 0.999}, small=20, bins=16).collect():
        assert tuple(r)[1:] == pytest.approx(np.quantile(vals, [0.1, 0.5, 0.999]))


def test_empty(spark):
    assert order_statistics(frame(spark, []), ["g"], "v", RANKS).collect() == []
    assert tuple(quantiles(frame(spark, [("a", 2, 3)]), [], "v", {"q": 0.5}, "w").first()) == (2.0,)


def test_panel_of_a_continuous_score(spark):
    rng = np.random.default_rng(9)
    vals = rng.random(3000) * 5
    p = co.metric_panel(frame(spark, [("a", v, 1) for v in vals]), ["g"], "v").first()
    assert p["median"] == pytest.approx(np.median(vals)) and p["p5"] == sorted(vals)[150] and p["n"] == 3000

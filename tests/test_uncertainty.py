import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import agreement as ag, calibration as ca, intervals as iv, replicates as rep


def scored(spark, n=4000, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice("xy"), rnd.choice("AB"), rnd.choice([1.0, 2.5, 4.0, 5.0])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, g string, s string, v double")


def test_bootstrap_matches_the_normal_interval(spark):
    rows, df = scored(spark)
    for r in iv.bootstrap_interval(df, "id", F.col("v"), ["g"], units=1000, replicates=1000).collect():
        vals = [x[3] for x in rows if x[1] == r.g]
        se = statistics.stdev(vals) / math.sqrt(len(vals))
        assert r.n == len(vals) and r["mean"] == pytest.approx(statistics.mean(vals))
        assert r.lo == pytest.approx(r["mean"] - 1.96 * se, abs=0.35 * se)
        assert r.hi == pytest.approx(r["mean"] + 1.96 * se, abs=0.35 * se)


def test_bootstrap_does_not_depend_on_partitioning(spark):
    _, df = scored(spark, 500)
    a, b = (iv.bootstrap_interval(df.repartition(p), "id", F.col("v"), ["g"], units=50, replicates=100).orderBy("g").collect() for p in (1, 13))
    assert [tuple(x)[1:] for x in a] == [pytest.approx(tuple(x)[1:]) for x in b]


def test_delta_of_identical_arms_is_paired(spark):
    rows = [(i, s, float(i % 5)) for i in range(300) for s in "AB"]
    df = spark.createDataFrame(rows, "id long, s string, v double")
    r = iv.delta_interval(df, "id", F.col("v"), "s", ("A", "B"), units=100, replicates=200).first()
    assert (r.delta, r.lo, r.hi, r.includes_zero) == (0.0, 0.0, 0.0, True)


def test_delta_of_different_arms(spark):
    rows = [(i, s, float(i % 2) + (3.0 if s == "B" else 0.0)) for i in range(300) for s in "AB"]
    df = spark.createDataFrame(rows, "id long, s string, v double")
    r = iv.delta_interval(df, "id", F.col("v"), "s", ("A", "B"), units=100, replicates=200).first()
    assert r.lo == pytest.approx(3.0) and not r.includes_zero


def test_rank_pick(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("b", 7.0), ("b", None)], "g string, v double")
    rows = {r.g: (r.lo, r.hi) for r in iv.rank_pick(df, ["g"], "v", iv.percentile_ranks()).collect()}
    assert rows == {"a": (2.0, 97.0), "b": (7.0, 7.0)}


def test_coverage_is_near_nominal(spark):
    df = spark.range(4000).select("id", (F.col("id") % 5 < 3).cast("int").alias("ok"))
    r = iv.coverage(df, "id", "ok", 100, 200, F.lit(0.6), F.lit(4000)).agg(F.avg(F.col("covers").cast("double")), F.count("*")).first()
    assert r[1] == 200 and 0.9 <= r[0] <= 0.99


def test_probabilities_and_curve(spark):
    post = iv.posterior(spark.createDataFrame([("g", 39, 50)], "g string, k long, n long"))
    probs = {r.prior: r.p_above for r in iv.prob_above(post, ["g", "prior"], 0.65).collect()}
    assert len(probs) == 4 and all(0.9 < p < 1 for p in probs.values())
    c = iv.curve(post, ["g", "prior"]).groupBy("prior").agg((F.sum("density") / 401).alias("area"), F.count("*").alias("n")).collect()
    assert all(r.n == 401 and r.area == pytest.approx(1) for r in c)


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 5.0), ("B", 5.0)], "s string, v double")
    rows = iv.histogram(df, F.col("v"), 0.5, 1.0, 5.0, "s", ["A", "B"]).orderBy("bin").collect()
    assert [(r.n_A, r.n_B) for r in rows] == [(1, 0)] + [(0, 0)] * 7 + [(1, 1)]


def test_width_multiplier(spark):
    df = spark.createDataFrame([("a", i * 0.1) for i in range(10)] + [("b", i * 0.3) for i in range(10)], "c string, v double")
    rows = {r.c: r.multiplier for r in iv.width_table(df, "c", "v", 0, lambda n: n - 1).collect()}
    assert rows["a"] == 1.0 and rows["b"] == pytest.approx(3.0)


def test_budget(spark):
    df = spark.createDataFrame([("g", 1.0, 0.0), ("g", 1.0, 1.0), ("g", 0.0, 0.0)], "g string, s double, t double")
    r = iv.uncertainty_budget(df, ["g"], F.col("s"), F.col("t")).first()
    vs, vj, b = statistics.variance([0, 1, 0]), statistics.variance([1, 0, 0]), 1 / 3
    assert r.combined == pytest.approx(math.sqrt(vs / 3 + vj / 3 + b * b))


def test_calibration(spark):
    df = spark.createDataFrame([(0.95, 1), (0.95, 0), (1.0, 1), (0.15, 0), (None, 0)], "p double, ok int")
    t = ca.reliability(df, "p", "ok")
    assert {r.bin: r.n for r in t.collect()} == {9: 3, 1: 1}
    e = ca.calibration_error(t).first()
    assert e.n == 4 and e.ece == pytest.approx((3 * abs(2.9 / 3 - 2 / 3) + 0.15) / 4)


def test_temperature_of_an_overconfident_model(spark):
    rows = [(0.99, 1, 70), (0.99, 0, 30)]
    df = spark.createDataFrame(rows, "p double, ok int, w long")
    best = ca.mark_best(ca.temperature_losses(df, "p", "ok", "w", [0.5, 1.0, 2.0, 5.0])).where("best").first()
    assert best.temperature == 5.0


def test_routing(spark):
    df = spark.createDataFrame([(0.9, 1, 1), (0.6, 0, 1), (None, 0, 1)], "p double, ok int, w int")
    rows = {r.cut: (r.kept, r.to_humans, r.accuracy) for r in ca.routing(df, "p", "ok", "w", [0.5, 0.8, 0.95]).collect()}
    assert rows == {0.5: (2, 1, 0.5), 0.8: (1, 2, 1.0), 0.95: (0, 3, None)}


def qcut_means(rows, n_bins):
    """Quantile bins, closed on the right, equal edges merged."""
    lens = sorted(x for x, _ in rows)
    q = min(n_bins, len(set(lens)))
    edges = []
    for i in range(q + 1):
        pos = i / q * (len(lens) - 1)
        lo = int(pos)
        v = lens[lo] + (pos - lo) * (lens[min(lo + 1, len(lens) - 1)] - lens[lo])
        if not edges or v != edges[-1]:
            edges.append(v)
    bins = {}
    for x, s in rows:
        bins.setdefault(sum(x > e for e in edges[1:-1]), []).append((x, s))
    return {b: (len(v), statistics.mean(x for x, _ in v), statistics.mean(s for _, s in v)) for b, v in bins.items()}


@pytest.mark.parametrize("lengths", [
    [3, 8, 1, 9, 4, 4, 7, 2, 2, 2, 30, 12], [5, 5, 5, 5, 5], [1, 2], [1, 1, 1, 1, 1, 1, 1, 9, 10],
])
def test_verbosity_bins(spark, lengths):
    rows = [(x, float(i % 2)) for i, x in enumerate(lengths)]
    df = spark.createDataFrame([(x, s, 1) for x, s in rows] + [(99, 1.0, 0)] * (0 if len(rows) < 4 else 3), "len int, s double, q int")
    got = {r.length_bin: (r.n, r.mean_len, r.mean_score) for r in ag.verbosity_curve(df, "len", "s", "q", 4).collect()}
    assert got == {b: pytest.approx(v) for b, v in qcut_means(rows, 4).items()}


def test_pooled_votes(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (0, 0, None), (None, None, None)], "a int, b int, c int")
    cols = ag.pooled(F.array("a", "b", "c"))
    rows = df.select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert [(r.n_raters, r.majority, r.contested) for r in rows] == [(3, 1, False), (3, 1, True), (2, 0, False), (0, None, None)]


def test_rerun_variance(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0), ("c", 2.0)], "i string, s double")
    r = ag.variance_split(ag.rerun_spread(df, "i", "s")).first()
    assert r["items"] == 3 and r.within_var == pytest.approx(1.0) and r.between_var == pytest.approx(statistics.variance([2, 5, 2]))


def test_hash_units_give_the_interval_of_the_row_bootstrap(spark):
    """A skewed score: the ends differ by a few parts in a hundred of the width."""
    rows = spark.range(6000).select("id", F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 250.0).alias("v"))
    units = iv.bootstrap_interval(rows.withColumn("g", F.lit(1)), "id", F.col("v"), ["g"], units=1000, replicates=400).first()
    plain = iv.bootstrap_interval(rows.withColumn("g", F.lit(1)), "id", F.col("v"), ["g"], units=None, replicates=400).first()
    assert units.n == plain.n == 6000 and abs(units["mean"] - plain["mean"]) < 1e-9
    width = plain.hi - plain.lo
    assert abs(units.lo - plain.lo) < 0.15 * width and abs(units.hi - plain.hi) < 0.15 * width


def poisson_of(key, salt, b):
    """The weight of a row in a replicate, written out."""
    m = hashlib.md5(f"{salt}:{key}".encode()).hexdigest()
    low, high = int(m[:8], 16), int(m[8:16], 16)
    z = (low + b * 0x9E3779B9) % 2**32
    z = (z ^ z >> 16) * 0x85EBCA6B % 2**32 ^ high
    z = (z ^ z >> 13) * 0xC2B2AE35 % 2**32
    u = (z ^ z >> 16) / 2**32
    k, cdf, term = 0, 0.0, math.exp(-1)
    while k < 12 and u >= cdf + term:
        cdf, term, k = cdf + term, term / (k + 1), k + 1
    return k


def test_row_replicates_are_the_weighted_sums(spark):
    rows = [(i, [None, "a", "b"][i % 3], i % 7 - 2.5 if i % 11 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, g string, v double").repartition(3)
    got = {(r["g"], r["__b"]): (r["__s"], r["__c"]) for r in rep.row_replicates(df, "id", F.col("v"), ["g"], 40, "t").collect()}
    want = {}
    for i, g, v in rows:
        for b in range(40 if v is not None else 0):
            s, c = want.get((g, b), (0.0, 0.0))
            w = poisson_of(i, "t", b)
            want[g, b] = s + w * v, c + w
    assert got == {k: (pytest.approx(s), c) for k, (s, c) in want.items()}


def test_weights_are_poisson_and_unrelated(spark):
    df = spark.range(3000).select("id", F.lit(1.0).alias("v"))
    reps = rep.row_replicates(df, "id", F.col("v"), [], 400).collect()
    sums = [r["__c"] for r in reps]
    assert len(sums) == 400 and abs(statistics.mean(sums) - 3000) < 4 * math.sqrt(3000 / 400)
    assert 0.8 * 3000 < statistics.variance(sums) < 1.2 * 3000  # rows are drawn apart from each other


def test_many_groups_and_no_rows(spark):
    """More groups than a task holds at once; a task returns some of them twice, and they are added up."""
    df = spark.range(4000).select("id", (F.col("id") % 1300).alias("g"), F.lit(2.0).alias("v"))
    got = rep.row_replicates(df.coalesce(1), "id", F.col("v"), ["g"], 5).collect()
    assert len(got) == 1300 * 5 and all(r["__s"] == 2 * r["__c"] for r in got)
    total = {r["__b"]: r["__c"] for r in rep.row_replicates(df, "id", F.col("v"), [], 5).collect()}
    assert all(sum(r["__c"] for r in got if r["__b"] == b) == total[b] for b in range(5))
    assert iv.bootstrap_interval(df.limit(0), "id", F.col("v"), ["g"]).collect() == []


def test_row_bootstrap_matches_the_normal_interval_and_pairs_by_key(spark):
    rows, df = scored(spark)
    for r in iv.bootstrap_interval(df, "id", F.col("v"), ["g"], replicates=1000).collect():
        vals = [x[3] for x in rows if x[1] == r.g]
        se = statistics.stdev(vals) / math.sqrt(len(vals))
        assert r.n == len(vals) and r.lo == pytest.approx(r["mean"] - 1.96 * se, abs=0.35 * se) and r.hi == pytest.approx(r["mean"] + 1.96 * se, abs=0.35 * se)
    both = spark.createDataFrame([(i, s, float(i % 5)) for i in range(300) for s in "AB"], "id long, s string, v double")
    r = iv.delta_interval(both, "id", F.col("v"), "s", ("A", "B"), replicates=200).first()
    assert (r.delta, r.lo, r.hi, r.includes_zero) == (0.0, 0.0, 0.0, True)
    a, b = (iv.bootstrap_interval(df.repartition(p), "id", F.col("v"), ["g"], replicates=100).orderBy("g").collect() for p in (1, 13))
    assert [tuple(x)[1:] for x in a] == [pytest.approx(tuple(x)[1:]) for x in b]


def test_bootstrap_coverage(spark):
    df = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(10)) < 7).cast("int").alias("ok"))
    truth, total = df.agg(F.avg("ok")).scalar(), df.agg(F.count("*")).scalar()
    got = iv.bootstrap_coverage(df, "id", "ok", 80, 60, truth, total, replicates=300).collect()
    assert len(got) == 60 and sum(r.covers for r in got) >= 50

import math

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import comparison as co, drift as dr, mixes as mx, reporting as rp


def panel(spark, rows):
    return co.metric_panel(spark.createDataFrame(rows, "system string, score double"), ["system"], "score")


def test_metric_panel_rules(spark):
    vals = [1.0, 2.0, 2.5, 4.0, 4.5, 5.0]
    r = panel(spark, [("A", v) for v in vals]).first()
    assert (r.n, r.median, r.p5, r.share_4_up) == (6, 3.25, 1.0, 0.5)
    mean = sum(vals) / 6
    assert r["std"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in vals) / 6))
    assert panel(spark, [("A", float(i)) for i in range(1, 41)]).first().p5 == 3.0  # sorted[floor(.05 * 40)]


def test_winners_direction_and_tie(spark):
    p = panel(spark, [("A", 3.0), ("A", 3.0), ("B", 1.0), ("B", 5.0)])
    w = {r.metric: r.winner for r in co.metric_winners(p, "system", ("A", "B")).collect()}
    assert w == {"mean": "tie", "median": "tie", "share_4_up": "B", "p5": "A", "std": "A"}


def test_custom_metric(spark):
    reg = co.default_metrics().register("worst", lambda s, w: F.min(s), True)
    df = spark.createDataFrame([("A", 2.0), ("A", 3.0), ("B", 1.0)], "system string, score double")
    p = co.metric_panel(df, ["system"], "score", reg)
    w = {r.metric: r.winner for r in co.metric_winners(p, "system", ("A", "B"), registry=reg).collect()}
    assert w["worst"] == "A"


def test_simpson_reversal(spark):
    cells = [("easy", "A", 87, 81), ("easy", "B", 270, 234), ("hard", "A", 263, 192), ("hard", "B", 80, 55)]
    df = spark.createDataFrame([(s, x, n, k) for s, x, n, k in cells], "segment string, system string, n_rows long, value_sum long")
    rows = co.simpson(df, "segment", "system", ("A", "B")).collect()
    assert all(r.reversal and r.against_overall for r in rows) and rows[0].overall_delta > 0


def test_corrections(spark):
    ps = [0.001, 0.01, 0.02, 0.03, 0.5, 0.5]
    df = spark.createDataFrame(list(enumerate(ps)), "id int, p_value double")
    rows = co.corrected(df, ["id"]).orderBy("id").collect()
    m = len(ps)
    holm = [min(1, max(ps[j] * (m - j) for j in range(i + 1))) for i in range(m)]
    bh = [min(1, min(ps[j] * m / (j + 1) for j in range(i, m))) for i in range(m)]
    assert [r.p_holm for r in rows] == pytest.approx(holm)
    assert [r.p_bh for r in rows] == pytest.approx(bh)
    assert [r.p_bonferroni for r in rows] == pytest.approx([min(1, p * m) for p in ps])


def test_two_proportions(spark):
    df = spark.createDataFrame([(78, 100, 90, 100), (0, 5, 0, 5)], "k1 int, n1 int, k2 int, n2 int")
    a, b = co.two_proportion(df, "k1", "n1", "k2", "n2").collect()
    z = 0.12 / math.sqrt(0.84 * 0.16 * 0.02)
    assert a.z == pytest.approx(z) and a.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)
    assert b.z is None and b.p_value == 1.0


def test_lucky_winner_and_gap(spark):
    t = spark.createDataFrame([(1, 0.6, 0.6), (2, 0.8, 0.5), (3, 0.7, 0.7)], "v int, acc_dev double, acc_test double")
    rows = co.lucky_winner(t, "v").orderBy("n_variants").collect()
    assert [(r.n_variants, r.winner, round(r.optimism, 6)) for r in rows] == [(1, 1, 0.0), (2, 2, 0.3), (3, 2, 0.3)]
    assert [r.best_dev for r in co.holdout_gap(t, "v").orderBy("v").collect()] == [0.6, 0.8, 0.8]


def test_reweighting_with_a_missing_segment(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 1.0)], "seg string, ok double")
    live = spark.createDataFrame([("a",)] * 2 + [("b",)] * 6 + [("c",)] * 2, "seg string")
    r = mx.reweight(mx.segment_means(df, "seg", {"ok": F.col("ok")}), mx.mix(live, "seg")).first()
    assert r.reweighted == pytest.approx((2 * 0.5 + 6 * 1.0) / 8) and r.missing_share == pytest.approx(0.2)


def test_bias_gap_bands(spark):
    df = spark.createDataFrame([("a", 5.0, 3.0)] * 3 + [("b", 3.0, 3.0)], "seg string, m double, n double")
    means = mx.segment_means(df, "seg", {"m": F.col("m"), "n": F.col("n")})
    test = mx.mix(df, "seg")
    live = spark.createDataFrame([("a", 1), ("b", 9)], "segment string, weight int")
    rows = {r.metric: r.band for r in mx.bias_gap(means, test, live).collect()}
    assert rows == {"m": "test flatters", "n": "close"}


def test_mix_ratio_of_unseen_segment(spark):
    a, b = (mx.mix(spark.createDataFrame([(x,) for x in s], "s string"), "s") for s in ("aab", "abbc"))
    rows = {r.segment: (r.test_share, r.production_share, r.ratio) for r in mx.compare_mixes(a, b).collect()}
    assert rows["c"] == (0.0, 0.25, 0.0) and rows["a"] == pytest.approx((2 / 3, 0.25, 8 / 3))


def test_breakdown(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 4.0), ("b", 2.0)], "seg string, v double")
    rows = {r.segment: (r.n, r.weak) for r in mx.breakdown(df, "seg", {"v": F.col("v")}).collect()}
    assert rows == {"(all)": (3, True), "a": (2, False), "b": (1, True)}


@pytest.mark.parametrize("delta, lo, hi, guard, worst, agree, verdict", [
    (0.06, 0.02, 0.10, 0.0, 0.0, 0.9, "ship"), (0.06, 0.02, 0.10, 0.05, 0.0, 0.9, "no ship"),
    (0.06, 0.02, 0.10, 0.0, -0.07, 0.9, "no ship"), (0.02, 0.01, 0.03, 0.0, 0.0, 0.9, "canary"),
    (0.06, -0.02, 0.14, 0.0, 0.0, 0.9, "inconclusive"), (0.06, 0.02, 0.10, 0.0, 0.0, 0.6, "inconclusive"),
    (-0.06, -0.10, -0.02, 0.0, 0.0, 0.9, "no ship"),
])
def test_ship_verdicts(spark, delta, lo, hi, guard, worst, agree, verdict):
    df = spark.createDataFrame([(delta, lo, hi, guard, worst, agree)], "d double, lo double, hi double, g double, w double, a double")
    crit = rp.ship_criteria(F.col("d"), F.col("lo"), F.col("hi"), F.col("g"), 0.01, F.col("w"), 0.02, F.col("a"))
    df = df.withColumn("c", crit)
    assert df.select(rp.ship_verdict(F.col("c"), F.col("lo"), F.col("hi")).alias("v")).first().v == verdict


def test_upper_median(spark):
    df = spark.createDataFrame([(i,) for i in (5, 1, 9, 7)], "v int")
    r = rp.size_stats(df, "v").first()
    assert (r.n, r["min"], r["median"], r["max"]) == (4, 1, 7, 9)


def series(spark, values, metric="m"):
    rows = [(metric, f"2024-01-{i + 1:02d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "metric string, ts string, score double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return dr.series(df, "ts", "metric", "score", "day")


def test_alert_is_strictly_below(spark):
    s = series(spark, [4.0, 3.5, 3.4, 3.6, 3.0])
    assert dr.drift_summary(s, 3.5).first().first_alert == "2024-01-03"
    assert dr.drift_summary(s, 2.0).first().first_alert == "Never"


def test_shock_and_delay(spark):
    s = series(spark, [5.0, 5.0, 3.0, 3.0, 3.0, 2.9, 2.8])
    r = dr.shock(s).first()
    assert (r.largest_drop, r.drop_period, r.kind) == (2.0, "2024-01-03", "shock")
    d = dr.detection_delay(s, 4.0, [3, 10]).first()
    assert (d.alert, d.alert_every_3, d.delay_every_3, d.alert_every_10) == (2, 3, 1, None)


def test_versions_agree_with_the_timeline(spark):
    ts = [f"2024-01-{d:02d} {h:02d}:00:00" for d in range(1, 12) for h in (0, 6, 12, 23)]
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    line = [("2024-01-02 06:00:00", "a"), ("2024-01-02 12:00:00", "b"), ("2024-01-09 00:30:00", "c")]
    table = spark.createDataFrame(line, "start string, version string").withColumn("start", F.col("start").cast("timestamp_ntz"))
    want = {i: next((v for s, v in reversed(line) if s <= t), None) for i, t in enumerate(ts)}
    literal = {r.id: r.v for r in facts.select("id", dr.version_at(F.col("ts"), line).alias("v")).collect()}
    joined = {r.id: r.version for r in dr.as_of_versions(facts, table, "ts", "start", "version").collect()}
    assert literal == want and joined == want


def test_regression_flag(spark):
    df = spark.createDataFrame([("m", "v1", 4.0, 0.1), ("m", "v2", 3.0, 0.1), ("m", "v3", 2.9, 0.1)], "metric string, version string, mean double, se double")
    rows = dr.version_change(df, "version").orderBy("version").collect()
    assert [r.regression for r in rows] == [False, True, False]

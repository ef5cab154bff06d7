"""Worked examples with known answers; all expected numbers are fixed values."""

import math

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.scores import half_step_score, normal_cdf
from gaugeline.operators import agreement as ag, classify as cl, ingest as ing, intervals as iv
from gaugeline.operators import judging as jd, reporting as rp

# Class names and published counts that results have to match.
CLASSES = ["ACCOUNT", "DELIVERY", "ORDER", "PAYMENT", "REFUND"]
CONFUSION = [
    [300, 8, 25, 0, 20], [2, 79, 3, 0, 32], [1, 3, 219, 0, 6], [1, 4, 19, 87, 11], [4, 11, 2, 1, 162],
]


def counts(spark, cells):
    return spark.createDataFrame(cells, "y_true string, y_pred string, n long")


def test_report_of_a_known_confusion_table(spark):
    cells = [(t, p, CONFUSION[i][j]) for i, t in enumerate(CLASSES) for j, p in enumerate(CLASSES)]
    c = counts(spark, cells)
    rows = {r["class"]: r for r in cl.per_class(c).collect()}
    assert {k: r.support for k, r in rows.items()} == dict(zip(CLASSES, (353, 116, 229, 122, 180)))
    assert [round(rows[k].recall, 3) for k in CLASSES] == [0.850, 0.681, 0.956, 0.713, 0.900]
    s = cl.summary(c).first()
    assert (s.n, s.correct, s.accuracy) == (1000, 847, 0.847)


def test_undefined_rates_and_no_answer(spark):
    c = counts(spark, [("a", "a", 3), ("a", "∅", 1), ("b", "a", 2), ("c", "x", 1)])
    rows = {r["class"]: r for r in cl.per_class(c).collect()}
    assert set(rows) == {"a", "b", "c"}  # neither the missing answer nor an unknown label is a class
    assert (rows["a"].tp, rows["a"].fp, rows["a"].fn) == (3, 2, 1)
    assert rows["b"].precision is None and rows["b"].recall == 0 and rows["b"].f1 == 0
    s = cl.summary(c).first()
    assert s.macro_precision == pytest.approx(3 / 5)  # undefined classes are left out
    assert s.macro_f1 == pytest.approx(rows["a"].f1 / 3)  # but count as 0 here


def test_given_label_set_adds_empty_classes(spark):
    c = counts(spark, [("a", "a", 3), ("z", "a", 1)])
    rows = {r["class"]: r for r in cl.per_class(c, classes=["a", "b"]).collect()}
    assert rows["b"].support == 0 and rows["b"].recall is None and rows["b"].precision is None
    s = cl.summary(c, classes=["a", "b"]).first()
    assert (s.n, s.correct) == (4, 3) and s.macro_recall == 1.0


def test_empty_input_has_no_accuracy(spark):
    s = cl.summary(counts(spark, [])).first()
    assert s.accuracy is None and s.macro_f1 == 0.0


def test_majority_tie_goes_to_the_first_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "y_true string")
    assert cl.majority_class(df).first().top_class == "a"


@pytest.mark.parametrize("overlap, tokens, strict, lenient, scale", [
    (1.0, 17, 1, 1, 5), (0.3579, 78, 0, 1, 3), (0.3830, 30, 0, 1, 3), (0.0909, 27, 0, 0, 2),
])
def test_rubric_judges(spark, overlap, tokens, strict, lenient, scale):
    cols = jd.rubric_scores(F.lit(overlap), F.lit(tokens))
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    assert (row.strict, row.lenient, row.scale_1_5) == (strict, lenient, scale)


@pytest.mark.parametrize("a, b, expected", [
    ([1, 1, 0, 0], [1, 1, 0, 0], 1.0), ([1, 1], [1, 1], 1.0), ([1, 1], [0, 0], 0.0),
    ([1, 0, 1, 0], [1, 1, 0, 0], 0.0), ([1, 1, 1, 0], [1, 1, 0, 0], 0.5),
])
def test_kappa(spark, a, b, expected):
    df = spark.createDataFrame(list(zip(a, b)), "a int, b int")
    one = ag.agreement_pairs(df, {"a": F.col("a"), "b": F.col("b")}).first()
    two = ag.agreement_pairs(df, {"x": F.col("b"), "y": F.col("a")}).first()
    assert one.kappa == pytest.approx(expected) and two.kappa == pytest.approx(expected)


def test_scorecard_overall(spark):
    df = spark.createDataFrame([(3.0, 4.0, 2.0), (1.0, 1.0, 1.0), (5.0, 5.0, 5.0), (None, 4.0, 2.0)],
                               "accuracy double, completeness double, fluency double")
    assert [r.o for r in df.select(rp.overall().alias("o")).collect()] == [3.5, 1.0, 5.0, None]


def test_half_steps_round_up(spark):
    df = spark.createDataFrame([(0.0,), (12.5,), (12.4,), (999.0,), (None,)], "v double")
    assert [r.s for r in df.select(half_step_score(F.col("v")).alias("s")).collect()] == [1.0, 1.5, 1.0, 5.0, None]


def test_bayes_example(spark):
    # 2% bad, 90% caught, 5% false flags: 18 true flags and 49 false ones in 1000
    rows = [(1, 1)] * 18 + [(0, 1)] * 2 + [(1, 0)] * 49 + [(0, 0)] * 931
    r = ag.flag_reliability(spark.createDataFrame(rows, "f int, b int"), F.col("f") == 1, F.col("b") == 1).first()
    assert (r.true_flags, r.flagged) == (18, 67)
    assert r.p_bad_given_flag == pytest.approx(18 / 67) == pytest.approx(r.p_bad_by_bayes)


def test_credible_interval_of_39_in_50(spark):
    post = iv.posterior(spark.createDataFrame([("g", 39, 50)], "g string, k long, n long"), priors=[("uniform", 1.0, 1.0)])
    r = iv.credible_interval(post, ["g", "prior"]).first()
    assert (round(r.lo, 3), round(r.hi, 3)) == (0.647, 0.872)


@pytest.mark.parametrize("k, n", [(0, 0), (0, 20), (20, 20), (900_000, 1_000_000)])
def test_posterior_edges(spark, k, n):
    post = iv.posterior(spark.createDataFrame([("g", k, n)], "g string, k long, n long"), priors=[("jeffreys", 0.5, 0.5)])
    p = post.first()
    assert (p.mode is None) == (min(p.alpha, p.beta) <= 1)
    r = iv.credible_interval(post, ["g", "prior"]).first()
    assert 0 <= r.lo < r.hi <= 1 and r.lo <= p.mean <= r.hi


@pytest.mark.parametrize("cpu, mem, expected", [
    (0.0, 0.0, 0.0), (1.0, 0.0, 1.0), (0.0, 1.0, 1.0), (0.6, 0.8, 1.0), (1.0, 1.0, math.sqrt(2)), (0.6, 0.4, 0.72111),
    (-0.01, 0.5, None), (1.01, 0.5, None), (0.5, -0.01, None), (0.5, 1.01, None), (1.5, 1.5, None), (-0.1, -0.1, None),
])
def test_host_score(spark, cpu, mem, expected):
    got = spark.range(1).select(ing.host_score(F.lit(cpu), F.lit(mem)).alias("s")).first().s
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-4)


def test_host_score_properties_on_a_grid(spark):
    grid = spark.range(121).select((F.floor(F.col("id") / 11) / 10).alias("a"), (F.col("id") % 11 / 10).alias("b"))
    s = {(round(r.a, 1), round(r.b, 1)): r.s for r in grid.select("a", "b", ing.host_score(F.col("a"), F.col("b")).alias("s")).collect()}
    for (a, b), v in s.items():
        assert 0 <= v <= math.sqrt(2) + 1e-12 and v == pytest.approx(s[(b, a)])
        if a < 1:
            assert s[(round(a + 0.1, 1), b)] >= v
        if b == 0:
            assert v == pytest.approx(a)


def test_normal_cdf(spark):
    zs = [-3.0, -1.0, 0.0, 0.5, 1.959963984540054]
    got = [r.p for r in spark.createDataFrame([(z,) for z in zs], "z double").select(normal_cdf(F.col("z")).alias("p")).collect()]
    assert got == pytest.approx([0.5 * (1 + math.erf(z / math.sqrt(2))) for z in zs], abs=1e-7)

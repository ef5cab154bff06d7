"""Segment mixes, metric choice, multiple tests, optimism and ship decisions."""

from pyspark.sql import functions as F

from gaugeline.functions.frames import with_grid
from gaugeline.functions.hashing import uniform
from gaugeline.operators import comparison as co, intervals as iv, mixes as mx, reporting as rp
from gaugeline.operators.replicates import row_weights_sql
from gaugeline.plans.registry import query, u_sql
from gaugeline.plans.uncertainty import row_boot_sql
from gaugeline.plans.views import QUALITY_EVAL, SCORES, quality_eval, scores, with_views
from gaugeline.sources.tables import table

MIX = """
mn AS (SELECT lang AS segment, metric, avg(v) AS mean FROM (
    SELECT lang, 'quality' AS metric, y_true::DOUBLE AS v FROM v_quality_eval UNION ALL
    SELECT lang, 'not_toxic', 1 - toxic FROM v_quality_eval UNION ALL
    SELECT lang, 'length_rule', CASE WHEN pred_A = y_true THEN 1 ELSE 0 END FROM v_quality_eval) GROUP BY ALL),
tm AS (SELECT lang AS segment, count(*) AS weight FROM v_quality_eval GROUP BY 1),
pm AS (SELECT lang AS segment, count(*) AS weight FROM documents GROUP BY 1)"""


def quality_metrics():
    return {"quality": F.col("y_true").cast("double"), "not_toxic": (1 - F.col("toxic")).cast("double"),
            "length_rule": (F.col("pred_A") == F.col("y_true")).cast("double")}


def quality_mixes(spark, d):
    q = quality_eval(spark, d)
    live = table(spark, d, "documents")
    return mx.segment_means(q, "lang", quality_metrics()), mx.mix(q, "lang"), mx.mix(live, "lang")


@query(with_views(QUALITY_EVAL, MIX) + """
SELECT metric, round(sum(weight * mean) / sum(weight), 6) AS reweighted,
  round(1 - sum(weight) / (SELECT sum(weight) FROM pm), 6) AS missing_share
FROM pm JOIN mn USING (segment) GROUP BY metric""")
def reweighted_scorecard(spark, d):
    means, _, live = quality_mixes(spark, d)
    return mx.reweight(means, live)


@query(with_views(QUALITY_EVAL, MIX, """
t AS (SELECT metric, sum(weight * mean) / sum(weight) AS v FROM tm JOIN mn USING (segment) GROUP BY 1),
p AS (SELECT metric, sum(weight * mean) / sum(weight) AS v FROM pm JOIN mn USING (segment) GROUP BY 1)""") + """
SELECT metric, round(t.v, 6) AS test_says, round(p.v, 6) AS production, round(t.v - p.v, 6) AS gap,
  CASE WHEN t.v - p.v > 15e-2 THEN 'test flatters' WHEN t.v - p.v < -15e-2 THEN 'test understates' ELSE 'close' END AS band
FROM t JOIN p USING (metric)""")
def bias_gap(spark, d):
    return mx.bias_gap(*quality_mixes(spark, d))


@query(with_views(QUALITY_EVAL, MIX, """
ts AS (SELECT segment, weight / sum(weight) OVER () AS s FROM tm),
ps AS (SELECT segment, weight / sum(weight) OVER () AS s FROM pm)""") + """
SELECT segment, round(coalesce(ts.s, 0), 6) AS test_share, round(coalesce(ps.s, 0), 6) AS production_share,
  round(coalesce(ts.s, 0) / nullif(ps.s, 0), 6) AS ratio, round(sum(coalesce(ts.s, 0)) OVER (), 6) AS total_test
FROM ts FULL JOIN ps USING (segment)""")
def mix_compare(spark, d):
    _, test, live = quality_mixes(spark, d)
    return mx.compare_mixes(test, live)


def metric_scores_wide():
    """Mean score per system as two metrics of a segment."""
    return {"score_A": F.when(F.col("system") == "A", F.col("score")),
            "score_B": F.when(F.col("system") == "B", F.col("score"))}


@query(with_views(SCORES) + """
SELECT CASE WHEN grouping(metric) = 1 THEN '(all)' ELSE metric END AS segment, count(*) AS n,
  round(avg(score) FILTER (system = 'A'), 6) AS score_A, round(avg(score) FILTER (system = 'B'), 6) AS score_B,
  least(avg(score) FILTER (system = 'A'), avg(score) FILTER (system = 'B')) < 35e-1 AS weak
FROM v_scores GROUP BY GROUPING SETS ((), (metric))""")
def segment_breakdown(spark, d):
    return mx.breakdown(scores(spark, d), "metric", metric_scores_wide())


PANEL = """
st AS (SELECT system, metric, score, row_number() OVER (PARTITION BY system, metric ORDER BY score) - 1 AS r,
    count(*) OVER (PARTITION BY system, metric) AS c FROM v_scores),
pn AS (SELECT system, metric, count(*) AS n, avg(score) AS mean, median(score) AS median,
    avg(CASE WHEN score >= 4 THEN 1e0 ELSE 0e0 END) AS share_4_up,
    max(score) FILTER (r = floor(5e-2 * c)) AS p5, stddev_pop(score) AS std FROM st GROUP BY ALL)"""


@query(with_views(SCORES, PANEL) + """
SELECT system, metric, n, round(mean, 6) AS mean, median, round(share_4_up, 6) AS share_4_up, p5, round(std, 6) AS std FROM pn""")
def metric_panel(spark, d):
    return co.metric_panel(scores(spark, d), ["system", "metric"], "score")


BOOT_PANEL = f"""
{row_weights_sql("(SELECT * FROM v_scores WHERE score IS NOT NULL)", "event_id", "system, score", 200, "panel")},
bh AS (SELECT system, b, score, sum(w) AS w FROM wt WHERE w > 0 GROUP BY ALL
  UNION ALL SELECT system, -1, score, count(*) FROM v_scores WHERE score IS NOT NULL GROUP BY ALL),
bc AS (SELECT *, sum(w) OVER (PARTITION BY system, b ORDER BY score) AS c, sum(w) OVER (PARTITION BY system, b) AS t FROM bh),
bm AS (SELECT system, b, sum(score * w) / sum(w)::DOUBLE AS mean, sum(w) FILTER (score >= 4) / sum(w)::DOUBLE AS share_4_up,
    min(score) FILTER (c > floor(t * 5e-2)) AS p5, sqrt(sum(score * score * w) / sum(w) - pow(sum(score * w) / sum(w), 2)) AS std FROM bc GROUP BY ALL),
bl AS (SELECT system, b, metric, value FROM bm UNPIVOT (value FOR metric IN (mean, share_4_up, p5, std))),
br AS (SELECT *, row_number() OVER (PARTITION BY system, metric ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY system, metric) AS n FROM bl WHERE b >= 0)"""


@query(with_views(SCORES, BOOT_PANEL) + """
SELECT system, metric, round(p.value, 6) AS value, round(max(br.value) FILTER (r = floor(25e-3 * n)), 6) AS lo,
  round(max(br.value) FILTER (r = floor(975e-3 * n)), 6) AS hi FROM br JOIN (SELECT * FROM bl WHERE b = -1) p USING (system, metric) GROUP BY ALL""")
def bootstrap_metrics(spark, d):
    """Intervals of registered metrics, one of them added by the caller."""
    registry = co.MetricRegistry([m for m in co.default_metrics().metrics.values() if m.id in ("mean", "share_4_up", "std")])
    registry.register_rank("p5", 0.05, True)
    return co.bootstrap_panel(scores(spark, d), "event_id", ["system"], "score", registry, replicates=200)


WINNERS = """
lg AS (SELECT system, metric AS segment, id, value FROM
    (SELECT system, metric, mean, median, share_4_up, p5, std FROM pn)
    UNPIVOT (value FOR id IN (mean, median, share_4_up, p5, std))),
wd AS (SELECT segment, id, max(value) FILTER (system = 'A') AS a, max(value) FILTER (system = 'B') AS b FROM lg GROUP BY ALL),
wn AS (SELECT *, CASE WHEN abs(b - a) < 1e-3 THEN 'tie' WHEN (b > a) = (id <> 'std') THEN 'B' ELSE 'A' END AS winner FROM wd)"""


def winner_table(spark, d):
    panel = co.metric_panel(scores(spark, d).withColumnRenamed("metric", "segment"), ["system", "segment"], "score")
    return co.metric_winners(panel, "system", ("A", "B"), by=["segment"])


@query(with_views(SCORES, PANEL, WINNERS) + """
SELECT segment, id AS metric, round(a, 6) AS value_A, round(b, 6) AS value_B, winner FROM wn""")
def metric_winners(spark, d):
    return winner_table(spark, d)


@query(with_views(SCORES, PANEL, WINNERS) + "SELECT segment, winner, count(*) AS wins FROM wn GROUP BY ALL")
def metric_wins(spark, d):
    return co.wins(winner_table(spark, d), by=["segment"])


@query(with_views(SCORES, """
pr AS (SELECT metric AS segment, avg(score) FILTER (system = 'B') - avg(score) FILTER (system = 'A') AS delta FROM v_scores GROUP BY 1),
al AS (SELECT avg(score) FILTER (system = 'B') - avg(score) FILTER (system = 'A') AS o FROM v_scores)""") + """
SELECT segment, round(delta, 6) AS delta, round(o, 6) AS overall_delta, sign(delta) = -sign(o) AND o <> 0 AS against_overall,
  bool_and(sign(delta) = -sign(o) AND o <> 0) OVER () AS reversal FROM pr, al""")
def simpson_check(spark, d):
    rows = scores(spark, d).withColumnRenamed("metric", "segment")
    sums = co.segment_sums(rows, ["segment", "system"], F.col("score"))
    return co.simpson(sums, "segment", "system", ("A", "B"))


@query(with_views(SCORES, """
ps AS (SELECT metric AS segment, count(*) AS n, avg(score) AS m, var_pop(score) AS v FROM v_scores GROUP BY 1)""") + """
SELECT count(*) AS segments, round(stddev_pop(m), 6) AS between_std, round(sqrt(sum(v * n) / sum(n)), 6) AS within_std,
  (SELECT segment FROM ps ORDER BY m, segment LIMIT 1) AS weakest, round(min(m), 6) AS weakest_mean,
  (SELECT segment FROM ps ORDER BY m DESC, segment DESC LIMIT 1) AS strongest, round(max(m), 6) AS strongest_mean FROM ps""")
def domain_variance(spark, d):
    return mx.domain_variance(scores(spark, d), "metric", F.col("score"))


TESTS = """
tt AS (SELECT metric, week, sum((score >= 4)::INT) FILTER (system = 'A') AS k1, count(*) FILTER (system = 'A') AS n1,
    sum((score >= 4)::INT) FILTER (system = 'B') AS k2, count(*) FILTER (system = 'B') AS n2
  FROM (SELECT *, date_trunc('week', day)::DATE::VARCHAR AS week FROM v_scores) GROUP BY ALL),
po AS (SELECT *, (k1 + k2) / (n1 + n2)::DOUBLE AS q FROM tt),
zz AS (SELECT *, CASE WHEN q * (1 - q) > 0 THEN (k2 / n2::DOUBLE - k1 / n1::DOUBLE) / sqrt(q * (1 - q) * (1e0 / n1 + 1e0 / n2)) END AS z FROM po),
ab AS (SELECT *, 1 / (1 + 2316419e-7 * abs(z)) AS t FROM zz),
pv AS (SELECT metric, week, k1, n1, k2, n2, z, coalesce(least(1, 2 * 3989422804014327e-16 * exp(-z * z / 2) * t * (31938153e-8 + t * (-356563782e-9
    + t * (1781477937e-9 + t * (-1821255978e-9 + t * 1330274429e-9))))), 1) AS p FROM ab),
rk AS (SELECT *, row_number() OVER (ORDER BY p, metric, week) AS i, count(*) OVER () AS m FROM pv),
ad AS (SELECT *, least(1, p * m) AS pb, least(1, max(p * (m - i + 1)) OVER (ORDER BY i)) AS ph,
    least(1, min(p * m / i) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS pf FROM rk)"""


@query(with_views(SCORES, TESTS) + """
SELECT metric, week, k1::BIGINT AS k1, n1, k2::BIGINT AS k2, n2, round(z, 6) AS z, round(p, 6) AS p_value,
  round(pb, 6) AS p_bonferroni, round(ph, 6) AS p_holm, round(pf, 6) AS p_bh,
  p < 5e-2 AS raw_hit, ph < 5e-2 AS holm_hit, pf < 5e-2 AS bh_hit FROM ad""")
def multiple_tests(spark, d):
    """Share of scores >= 4, A against B, for every metric and week."""
    s = scores(spark, d).withColumn("week", F.trunc("day", "week").cast("date").cast("string"))
    good = (F.col("score") >= 4).cast("int")
    cells = []
    for i, name in ((1, "A"), (2, "B")):
        mine = F.col("system") == name
        cells += [F.sum(F.when(mine, good)).alias(f"k{i}"), F.count_if(mine).alias(f"n{i}")]
    tests = s.groupBy("metric", "week").agg(*cells)
    return co.corrected(co.two_proportion(tests, "k1", "n1", "k2", "n2"), ["metric", "week"])


CUTS = [100 * i for i in range(1, 21)]
_V = u_sql("doc_id", "'lucky'")
VARIANTS = f"""
vr AS (SELECT cut, CASE WHEN {_V} < 5e-1 THEN 'dev' ELSE 'test' END AS split,
    CASE WHEN (n_chars >= cut)::INT = y_true THEN 1e0 ELSE 0e0 END AS ok
  FROM v_quality_eval, (SELECT 100 * i AS cut FROM range(1, 21) r(i))),
ac AS (SELECT cut, avg(ok) FILTER (split = 'dev') AS dev, avg(ok) FILTER (split = 'test') AS test FROM vr GROUP BY 1)"""


def variant_accuracy(spark, d):
    """Twenty length rules, scored on a dev and a sealed half.

    Rows are counted per (length up to the last cut, truth, half) before the rules multiply them.
    """
    q = quality_eval(spark, d).select("doc_id", F.least("n_chars", F.lit(CUTS[-1])).alias("n_chars"), "y_true")
    q = q.withColumn("split", F.when(uniform(F.col("doc_id"), "lucky") < 0.5, "dev").otherwise("test"))
    q = q.groupBy("n_chars", "y_true", "split").agg(F.count("*").alias("n"))
    right = (F.col("n_chars") >= F.col("cut")).cast("int") == F.col("y_true")
    return co.split_accuracy(with_grid(q, "cut", CUTS), "cut", "split", right, ["dev", "test"], F.col("n"))


@query(with_views(QUALITY_EVAL, VARIANTS, """
pf AS (SELECT a.cut, b.cut AS c, b.dev, b.test, row_number() OVER (PARTITION BY a.cut ORDER BY b.dev DESC, b.cut) AS r,
    count(*) OVER (PARTITION BY a.cut) AS n FROM ac a JOIN ac b ON b.cut <= a.cut)""") + """
SELECT n AS n_variants, c::INT AS winner, round(dev, 6) AS dev, round(test, 6) AS sealed, round(dev - test, 6) AS optimism FROM pf WHERE r = 1""")
def lucky_winner(spark, d):
    return co.lucky_winner(variant_accuracy(spark, d), "cut")


@query(with_views(QUALITY_EVAL, VARIANTS) + """
SELECT cut::INT AS cut, round(dev, 6) AS acc_dev, round(test, 6) AS acc_test, round(dev - test, 6) AS gap,
  round(max(dev) OVER (ORDER BY cut), 6) AS best_dev FROM ac""")
def holdout_gap(spark, d):
    return co.holdout_gap(variant_accuracy(spark, d), "cut")


@query(with_views(SCORES) + """
SELECT user_id, count(*) AS n, max(score) - min(score) AS score_range,
  max((score >= 3)::INT) <> min((score >= 3)::INT) AS flips FROM v_scores GROUP BY 1""")
def variant_spread(spark, d):
    return co.variant_spread(scores(spark, d), "user_id", "score", 3.0)


# Scorecards: the three dimensions of a line item, in half steps from 1 to 5.
CARDS = """
v_cards AS (SELECT l_orderkey, l_linenumber, 1 + floor(l_quantity * 8 / 50 + 5e-1) / 2 AS accuracy,
    1 + floor(l_discount * 80 + 5e-1) / 2 AS completeness, 1 + floor(l_tax * 100 + 5e-1) / 2 AS fluency FROM lineitem)"""


def cards(spark, d):
    li = table(spark, d, "lineitem")

    def half(c):
        return 1 + F.floor(c + 0.5) / 2

    return li.select(
        "l_orderkey", "l_linenumber", half(F.col("l_quantity") * 8 / 50).alias("accuracy"),
        half(F.col("l_discount") * 80).alias("completeness"), half(F.col("l_tax") * 100).alias("fluency"))


@query(with_views(CARDS) + """
SELECT accuracy, completeness, fluency, least(5e0, greatest(1e0,
  round_even((45e-2 * accuracy + 45e-2 * completeness + 1e-1 * fluency) * 2, 0) / 2)) AS overall, count(*) AS n
FROM v_cards GROUP BY ALL""")
def scorecard_overall(spark, d):
    """Overall per scorecard; equal cards are counted, not repeated."""
    distinct = cards(spark, d).groupBy("accuracy", "completeness", "fluency").agg(F.count("*").alias("n"))
    return distinct.withColumn("overall", rp.overall())


@query(with_views(CARDS) + """
SELECT count(*) AS n, round(avg(accuracy), 6) AS accuracy, round(avg(completeness), 6) AS completeness,
  round(avg(fluency), 6) AS fluency, round(avg(least(5e0, greatest(1e0,
  round_even((45e-2 * accuracy + 45e-2 * completeness + 1e-1 * fluency) * 2, 0) / 2))), 6) AS overall FROM v_cards""")
def scorecard_means(spark, d):
    rows = cards(spark, d).withColumn("overall", rp.overall())
    return rp.means(rows, ["accuracy", "completeness", "fluency", "overall"])


COMPARE = """
v_sys AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS system, accuracy, completeness, fluency,
    least(5e0, greatest(1e0, round_even((45e-2 * accuracy + 45e-2 * completeness + 1e-1 * fluency) * 2, 0) / 2)) AS overall FROM v_cards),
sm AS (SELECT system, avg(accuracy) AS accuracy, avg(completeness) AS completeness, avg(fluency) AS fluency, avg(overall) AS overall FROM v_sys GROUP BY 1),
sl AS (SELECT system, metric, value FROM sm UNPIVOT (value FOR metric IN (accuracy, completeness, fluency, overall))),
sw AS (SELECT metric, max(value) FILTER (system = 'A') AS a, max(value) FILTER (system = 'B') AS b FROM sl GROUP BY 1),
sc AS (SELECT *, CASE WHEN b - a > 1e-2 THEN 'B' WHEN a - b > 1e-2 THEN 'A' ELSE 'tie' END AS winner FROM sw)"""


def compared_cards(spark, d):
    rows = cards(spark, d).withColumns({
        "system": F.when(F.col("l_orderkey") % 2 == 0, "A").otherwise("B"), "overall": rp.overall()})
    return co.scorecard_winners(rows, "system", ("A", "B"), ["accuracy", "completeness", "fluency", "overall"])


@query(with_views(CARDS, COMPARE) + "SELECT metric, round(a, 6) AS mean_A, round(b, 6) AS mean_B, winner FROM sc")
def scorecard_compare(spark, d):
    """Mean of every scorecard metric per system; a lead of more than 0.01 wins."""
    return compared_cards(spark, d)


@query(with_views(CARDS, COMPARE) + "SELECT winner, count(*) AS wins FROM sc GROUP BY 1")
def scorecard_wins(spark, d):
    return co.wins(compared_cards(spark, d))


SHIP_BOOT = row_boot_sql("v_ship", "event_id", "ok", "system", 2000, "ship")


@query(with_views(SCORES, QUALITY_EVAL, """
v_ship AS (SELECT event_id, system, metric, CASE WHEN score >= 15e-1 THEN 1e0 ELSE 0e0 END AS ok FROM v_scores)""", SHIP_BOOT, """
dl AS (SELECT b, max(m) FILTER (system = 'B') - max(m) FILTER (system = 'A') AS d FROM rp GROUP BY 1),
rk AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS r, count(*) OVER () AS n FROM dl),
ci AS (SELECT max(d) FILTER (r = floor(25e-3 * n)) AS lo, max(d) FILTER (r = floor(975e-3 * n)) AS hi FROM rk),
sg AS (SELECT metric, avg(ok) FILTER (system = 'B') - avg(ok) FILTER (system = 'A') AS d FROM v_ship GROUP BY 1),
x AS (SELECT (SELECT avg(ok) FILTER (system = 'B') - avg(ok) FILTER (system = 'A') FROM v_ship) AS delta, lo, hi,
  (SELECT avg(CASE WHEN score <= 1 THEN 1e0 ELSE 0e0 END) FILTER (system = 'B')
     - avg(CASE WHEN score <= 1 THEN 1e0 ELSE 0e0 END) FILTER (system = 'A') FROM v_scores) AS guardrail,
  (SELECT min(d) FROM sg) AS worst, (SELECT avg(CASE WHEN y_true = pred_A THEN 1e0 ELSE 0e0 END) FROM v_quality_eval) AS agree FROM ci),
cr AS (SELECT 'gain' AS criterion, delta AS value, delta >= 4e-2 AS passed FROM x UNION ALL
  SELECT 'range_excludes_0', lo, lo > 0 FROM x UNION ALL SELECT 'guardrail', guardrail, guardrail <= 1e-2 FROM x UNION ALL
  SELECT 'worst_segment', worst, worst >= -2e-2 FROM x UNION ALL SELECT 'judge_agreement', agree, agree >= 8e-1 FROM x)""") + """
SELECT criterion, round(value, 6) AS value, passed, (SELECT CASE WHEN agree < 8e-1 THEN 'inconclusive' WHEN hi < 0 THEN 'no ship'
  WHEN guardrail > 1e-2 OR worst < -2e-2 THEN 'no ship' WHEN delta >= 4e-2 AND lo > 0 THEN 'ship'
  WHEN lo <= 0 THEN 'inconclusive' ELSE 'canary' END FROM x) AS verdict FROM cr""")
def ship_report(spark, d):
    """B against A: gain, its range, a guardrail, every segment and the judge."""
    s = scores(spark, d).withColumns({
        "ok": (F.col("score") >= 1.5).cast("double"), "bad": (F.col("score") <= 1).cast("double")})
    gain = iv.delta_interval(s, "event_id", F.col("ok"), "system", ("A", "B"), salt="ship")

    def delta(c):
        return F.avg(F.when(F.col("system") == "B", F.col(c))) - F.avg(F.when(F.col("system") == "A", F.col(c)))

    guard = s.agg(delta("bad")).scalar()
    worst = s.groupBy("metric").agg(delta("ok").alias("d")).agg(F.min("d")).scalar()
    q = quality_eval(spark, d)
    agree = q.agg(F.avg((F.col("y_true") == F.col("pred_A")).cast("double"))).scalar()
    rows = gain.withColumns({"guard": guard, "worst": worst, "agree": agree})
    crit = rp.ship_criteria(F.col("delta"), F.col("lo"), F.col("hi"), F.col("guard"), 0.01, F.col("worst"), 0.02, F.col("agree"))
    rows = rows.withColumn("c", crit)
    rows = rows.withColumn("verdict", rp.ship_verdict(F.col("c"), F.col("lo"), F.col("hi")))
    return rows.select(F.explode("c").alias("c"), "verdict").select("c.*", "verdict")


# Reports submitted per system, metric and day; each leaves some fields empty.
REPORTS = """
v_reports AS (SELECT system, metric, day::VARCHAR AS day, count(*) AS k, nullif(count(*) % 7, 0) AS n,
    CASE WHEN count(*) > 5 THEN min(score) END AS range_lo, CASE WHEN count(*) > 5 THEN max(score) END AS range_hi,
    nullif(count(DISTINCT user_id), count(*)) AS breakdown, CASE WHEN min(score) > 1 THEN min(score) END AS guardrail,
    CASE WHEN system = 'A' THEN count(*) END AS calibration, CASE WHEN day(day) > 15 THEN 1 END AS rebaseline
  FROM v_scores GROUP BY system, metric, day)"""


def reports(spark, d):
    n = F.count("*")
    grouped = scores(spark, d).groupBy("system", "metric", "day").agg(
        n.alias("k"), F.min("score").alias("lo"), F.max("score").alias("hi"), F.count_distinct("user_id").alias("users"))
    k = F.col("k")
    return grouped.select(
        "system", "metric", F.col("day").cast("string").alias("day"), F.nullif(k % 7, F.lit(0)).alias("n"),
        F.when(k > 5, F.col("lo")).alias("range_lo"), F.when(k > 5, F.col("hi")).alias("range_hi"),
        F.nullif(F.col("users"), k).alias("breakdown"), F.when(F.col("lo") > 1, F.col("lo")).alias("guardrail"),
        F.when(F.col("system") == "A", k).alias("calibration"), F.when(F.dayofmonth("day") > 15, 1).alias("rebaseline"))


_FIELDS = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in rp.REPORT_FIELDS)


@query(with_views(SCORES, REPORTS, f"""
fl AS (SELECT system, metric, day, list_filter([{_FIELDS}], lambda x: x IS NOT NULL) AS f FROM v_reports)""") + """
SELECT system, metric, day, array_to_string(f, ',') AS missing, len(f)::INT AS n_missing, len(f) = 0 AS complete FROM fl""")
def report_flags(spark, d):
    return rp.report_flags(reports(spark, d), ["system", "metric", "day"])


@query("""
WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS i, count(*) OVER (PARTITION BY lang) AS c FROM documents)
SELECT lang, count(*) AS n, min(n_chars) AS min, max(n_chars) FILTER (i = floor(c / 2) + 1) AS median, max(n_chars) AS max FROM r GROUP BY 1""")
def corpus_stats(spark, d):
    return rp.size_stats(table(spark, d, "documents"), "n_chars", ["lang"])

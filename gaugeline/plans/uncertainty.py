"""Calibration and uncertainty intervals on the given tables."""

from itertools import accumulate
from math import factorial

from pyspark.sql import functions as F

from gaugeline.operators import calibration as ca, intervals as iv
from gaugeline.operators.replicates import row_weights_sql
from gaugeline.plans.registry import query, u_sql, unit_sql
from gaugeline.plans.views import (
    LANG_EVAL, QUALITY_EVAL, SCORES, lang_eval, quality_eval, scores, with_views)

RIGHT = "CASE WHEN y_true = y_pred THEN 1 ELSE 0 END"


def lang_right(spark, d):
    right = F.coalesce(F.col("y_true") == F.col("y_pred"), F.lit(False)).cast("int")
    return lang_eval(spark, d).withColumn("correct", right)


def conf_counts(spark, d):
    """Rows per distinct (confidence, correct), summed before any grid multiplies them."""
    return lang_right(spark, d).groupBy("conf", "correct").agg(F.count("*").alias("n"))


BINS = f"""
rb AS (SELECT least(floor(conf * 10), 9)::INT AS bin, count(*) AS n, avg(conf) AS mean_conf, avg({RIGHT}) AS accuracy
  FROM v_lang_eval WHERE conf IS NOT NULL GROUP BY 1)"""


@query(with_views(LANG_EVAL, BINS) + """
SELECT bin, n, round(mean_conf, 6) AS mean_conf, round(accuracy, 6) AS accuracy FROM rb""")
def reliability_bins(spark, d):
    return ca.reliability(lang_right(spark, d), "conf", "correct")


@query(with_views(LANG_EVAL, BINS) + """
SELECT sum(n)::BIGINT AS n, round(sum(n * abs(mean_conf - accuracy)) / sum(n), 6) AS ece,
  round(sum(n * accuracy) / sum(n), 6) AS accuracy, round(max(abs(mean_conf - accuracy)), 6) AS max_gap FROM rb""")
def ece(spark, d):
    return ca.calibration_error(ca.reliability(lang_right(spark, d), "conf", "correct"))


TEMPERATURES = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0]


@query(with_views(LANG_EVAL, f"""
c AS (SELECT least(1 - 1e-6, greatest(1e-6, conf)) AS p, {RIGHT} AS ok FROM v_lang_eval WHERE conf IS NOT NULL),
g AS (SELECT t, ok, 1 / (1 + exp(-ln(p / (1 - p)) / t)) AS q FROM c,
  (VALUES (5e-1), (75e-2), (1e0), (15e-1), (2e0), (3e0)) k(t)),
l AS (SELECT t, avg(CASE WHEN ok = 1 THEN -ln(q) ELSE -ln(1 - q) END) AS loss FROM g GROUP BY t)""") + """
SELECT t AS temperature, round(loss, 6) AS log_loss, t = (SELECT arg_min(t, loss) FROM l) AS best FROM l""")
def temperature_sweep(spark, d):
    return ca.mark_best(ca.temperature_losses(conf_counts(spark, d).where("conf IS NOT NULL"), "conf", "correct", "n", TEMPERATURES))


CUTS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]


@query(with_views(LANG_EVAL) + f"""
SELECT cut, count(*) FILTER (conf >= cut) AS kept, count(*) FILTER (conf IS NULL OR conf < cut) AS to_humans,
  round(count(*) FILTER (conf >= cut) / count(*), 6) AS coverage, round(avg({RIGHT}) FILTER (conf >= cut), 6) AS accuracy
FROM v_lang_eval, (VALUES (3e-1), (4e-1), (5e-1), (6e-1), (7e-1), (8e-1), (9e-1), (1e0)) k(cut) GROUP BY cut""")
def routing_curve(spark, d):
    return ca.routing(conf_counts(spark, d), "conf", "correct", "n", CUTS)


GROUPS = f"""
gk AS (SELECT y_true AS lang, count(*) AS n, sum({RIGHT})::BIGINT AS k FROM v_lang_eval GROUP BY 1)"""
POST = """
po AS (SELECT lang, prior, k, n, a0 + k AS alpha, b0 + n - k AS beta,
    (a0 + k) / (a0 + b0 + n) AS mean FROM gk, (VALUES ('uniform', 1e0, 1e0), ('jeffreys', 5e-1, 5e-1),
    ('weak', 2e0, 2e0), ('optimistic', 8e0, 2e0)) p(prior, a0, b0))"""
GRID = """
sd AS (SELECT *, sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) AS s FROM po),
gr AS (SELECT lang, prior, alpha, beta, i, greatest(0e0, mean - 8 * s)
    + (i + 5e-1) * (least(1e0, mean + 8 * s) - greatest(0e0, mean - 8 * s)) / 4000 AS x FROM sd, range(4000) r(i)),
ld AS (SELECT *, (alpha - 1) * ln(x) + (beta - 1) * ln(1 - x) AS l FROM gr),
de AS (SELECT *, exp(l - max(l) OVER (PARTITION BY lang, prior)) AS e FROM ld),
cd AS (SELECT *, e / sum(e) OVER (PARTITION BY lang, prior) AS mass,
    sum(e) OVER (PARTITION BY lang, prior ORDER BY i) / sum(e) OVER (PARTITION BY lang, prior) AS cdf FROM de)"""
KEYS = ["lang", "prior"]


def posteriors(spark, d):
    groups = lang_right(spark, d).groupBy(F.col("y_true").alias("lang")).agg(
        F.count("*").alias("n"), F.sum("correct").alias("k"))
    return iv.posterior(groups)


@query(with_views(LANG_EVAL, GROUPS, POST) + """
SELECT lang, prior, n, k, alpha, beta, round(k / n, 6) AS empirical, round(mean, 6) AS mean,
  CASE WHEN alpha > 1 AND beta > 1 THEN round((alpha - 1) / (alpha + beta - 2), 6) END AS mode FROM po""")
def beta_posterior(spark, d):
    return posteriors(spark, d)


@query(with_views(LANG_EVAL, GROUPS, POST, GRID) + """
SELECT lang, prior, round(min(x) FILTER (cdf >= 25e-3), 6) AS lo, round(min(x) FILTER (cdf >= 975e-3), 6) AS hi
FROM cd GROUP BY ALL""")
def credible_interval(spark, d):
    return iv.credible_interval(posteriors(spark, d), KEYS)


@query(with_views(LANG_EVAL, GROUPS, POST, GRID) + """
SELECT lang, prior, round(coalesce(sum(mass) FILTER (x > 9e-1), 0), 6) AS p_above FROM cd GROUP BY ALL""")
def prob_above(spark, d):
    return iv.prob_above(posteriors(spark, d), KEYS, 0.9)


@query(with_views(LANG_EVAL, GROUPS, POST, """
gr AS (SELECT lang, prior, alpha, beta, i, (i + 5e-1) / 401 AS x FROM po, range(401) r(i)),
ld AS (SELECT *, (alpha - 1) * ln(x) + (beta - 1) * ln(1 - x) AS l FROM gr),
de AS (SELECT *, exp(l - max(l) OVER (PARTITION BY lang, prior)) AS e FROM ld)""") + """
SELECT lang, prior, i::INT AS i, round(x, 6) AS x, round(e / sum(e) OVER (PARTITION BY lang, prior) * 401, 6) AS density FROM de""")
def posterior_curve(spark, d):
    return iv.curve(posteriors(spark, d), KEYS)


POISSON = "CASE " + " ".join(f"WHEN u < {b!r} THEN {k}" for k, b in enumerate(
    accumulate(0.36787944117144233 / factorial(k) for k in range(12)))) + " ELSE 12 END"


def boot_sql(source, key, value, by, units, reps, salt):
    cols = f"{by}, " if by else ""
    return f"""
us AS (SELECT {cols}{unit_sql(key, units)} AS unit, sum({value}) AS s, count(*) AS c FROM {source} GROUP BY ALL),
ut AS (SELECT DISTINCT unit FROM us),
wt AS (SELECT unit, b, {POISSON} AS w FROM (SELECT unit, b, {u_sql("(unit::VARCHAR || ':' || b::VARCHAR)", f"'{salt}'")} AS u
  FROM ut, range({reps}) r(b))),
rp AS (SELECT {cols}b, sum(w * s) / sum(w * c)::DOUBLE AS m FROM us JOIN wt USING (unit) WHERE w > 0 GROUP BY ALL)"""


def row_boot_sql(source, key, value, by, reps, salt):
    """Replicate means with rows as units: rp (by, b, m)."""
    return row_weights_sql(f"(SELECT * FROM {source} WHERE {value} IS NOT NULL)", key, f"{by}, {value}", reps, salt) + f""",
rp AS (SELECT {by}, b, sum(w * {value}) / sum(w)::DOUBLE AS m FROM wt GROUP BY ALL HAVING sum(w) > 0)"""


RANKED = """
rk AS (SELECT {by}, {m}, row_number() OVER (PARTITION BY {by} ORDER BY {m}) - 1 AS r, count(*) OVER (PARTITION BY {by}) AS n FROM {source}),
ci AS (SELECT {by}, max({m}) FILTER (r = floor(25e-3 * n)) AS lo, max({m}) FILTER (r = floor(975e-3 * n)) AS hi FROM rk GROUP BY 1)"""


@query(with_views(SCORES, row_boot_sql("v_scores", "event_id", "score", "metric", 2000, "boot"), RANKED.format(by="metric", m="m", source="rp")) + """
SELECT metric, n, round(mean, 6) AS mean, round(lo, 6) AS lo, round(hi, 6) AS hi FROM
  (SELECT metric, count(*) AS n, avg(score) AS mean FROM v_scores GROUP BY 1) JOIN ci USING (metric)""")
def bootstrap_ci(spark, d):
    """Percentile intervals of the mean score; rows are the units."""
    return iv.bootstrap_interval(scores(spark, d), "event_id", F.col("score"), ["metric"])


@query(with_views(SCORES, boot_sql("v_scores", "event_id", "score", "metric", 1000, 2000, "boot"), RANKED.format(by="metric", m="m", source="rp")) + """
SELECT metric, n, round(mean, 6) AS mean, round(lo, 6) AS lo, round(hi, 6) AS hi FROM
  (SELECT metric, count(*) AS n, avg(score) AS mean FROM v_scores GROUP BY 1) JOIN ci USING (metric)""")
def bootstrap_ci_units(spark, d):
    """The same with 1000 hash groups of rows as units, at a cost that the number of rows does not change."""
    return iv.bootstrap_interval(scores(spark, d), "event_id", F.col("score"), ["metric"], units=1000)


@query(with_views(SCORES, row_boot_sql("v_scores", "event_id", "score", "metric, system", 2000, "delta"), """
dl AS (SELECT metric, b, max(m) FILTER (system = 'B') - max(m) FILTER (system = 'A') AS d FROM rp GROUP BY ALL)""", RANKED.format(by="metric", m="d", source="dl")) + """
SELECT metric, round(delta, 6) AS delta, round(lo, 6) AS lo, round(hi, 6) AS hi, lo <= 0 AND hi >= 0 AS includes_zero FROM
  (SELECT metric, avg(score) FILTER (system = 'B') - avg(score) FILTER (system = 'A') AS delta FROM v_scores GROUP BY 1)
  JOIN ci USING (metric)""")
def delta_ci(spark, d):
    """Percentile intervals of the difference of the systems' means; rows are the units."""
    return iv.delta_interval(
        scores(spark, d), "event_id", F.col("score"), "system", ("A", "B"), ["metric"], salt="delta")


@query(with_views(QUALITY_EVAL, """
dr AS (SELECT * FROM (SELECT s.seed, doc_id, y_true, row_number() OVER (PARTITION BY s.seed ORDER BY md5(s.seed::VARCHAR || ':' || doc_id::VARCHAR)) AS i
  FROM v_quality_eval v, range(100) s(seed)) WHERE i <= 60)""", row_boot_sql("dr", "doc_id", "y_true", "seed", 500, "cover"), RANKED.format(by="seed", m="m", source="rp")) + """,
q AS (SELECT lo, hi, (SELECT avg(y_true) FROM v_quality_eval) AS truth FROM ci)
SELECT count(*) AS draws, round(max(truth), 6) AS truth, round(avg(CASE WHEN lo <= truth AND truth <= hi THEN 1e0 ELSE 0e0 END), 6) AS coverage,
  round(avg(hi - lo), 6) AS mean_width FROM q""")
def bootstrap_coverage(spark, d):
    """How often the bootstrap interval of a draw of 60 contains the value of the whole pool."""
    q = quality_eval(spark, d).select("doc_id", "y_true")
    total, truth = q.agg(F.count("*")).scalar(), q.agg(F.avg("y_true")).scalar()
    table = iv.bootstrap_coverage(q, "doc_id", "y_true", 60, 100, truth, total)
    return table.agg(F.count("*").alias("draws"), F.max("truth").alias("truth"),
                     F.avg(F.col("covers").cast("double")).alias("coverage"),
                     F.avg(F.col("hi") - F.col("lo")).alias("mean_width"))


@query(with_views(QUALITY_EVAL, """
rk AS (SELECT s.seed, v.y_true, row_number() OVER (PARTITION BY s.seed ORDER BY md5(s.seed::VARCHAR || ':' || doc_id::VARCHAR)) AS i
  FROM v_quality_eval v, range(100) s(seed)),
gk AS (SELECT seed AS lang, count(*) AS n, sum(y_true)::BIGINT AS k FROM rk WHERE i <= 60 GROUP BY 1)""", POST.replace("""(VALUES ('uniform', 1e0, 1e0), ('jeffreys', 5e-1, 5e-1),
    ('weak', 2e0, 2e0), ('optimistic', 8e0, 2e0))""", "(VALUES ('uniform', 1e0, 1e0))"), GRID, """
q AS (SELECT lang, min(x) FILTER (cdf >= 25e-3) AS lo, min(x) FILTER (cdf >= 975e-3) AS hi, (SELECT avg(y_true) FROM v_quality_eval) AS truth FROM cd GROUP BY 1)""") + """
SELECT count(*) AS draws, round(max(truth), 6) AS truth, round(avg(CASE WHEN lo <= truth AND truth <= hi THEN 1e0 ELSE 0e0 END), 6) AS coverage,
  round(avg(hi - lo), 6) AS mean_width FROM q""")
def ci_coverage(spark, d):
    q = quality_eval(spark, d).select("doc_id", "y_true")
    total, truth = q.agg(F.count("*")).scalar(), q.agg(F.avg("y_true")).scalar()
    table = iv.coverage(q, "doc_id", "y_true", 60, 100, truth, total)
    return table.agg(F.count("*").alias("draws"), F.max("truth").alias("truth"),
                     F.avg(F.col("covers").cast("double")).alias("coverage"),
                     F.avg(F.col("hi") - F.col("lo")).alias("mean_width"))


@query(with_views(SCORES, """
m AS (SELECT system, day, avg(score) AS v FROM v_scores GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY system ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY system) AS n FROM m),
p AS (SELECT system, max(v) FILTER (r = 1) AS lo, max(v) FILTER (r = n - 2) AS hi FROM rk GROUP BY 1)""") + """
SELECT system, round(lo, 6) AS lo, round(hi, 6) AS hi, round(greatest(hi - lo, 1e-2), 6) AS width,
  round(greatest(hi - lo, 1e-2) / min(greatest(hi - lo, 1e-2)) OVER (), 6) AS multiplier FROM p""")
def width_multiplier(spark, d):
    """Each day is a repeat run of both systems; the second-lowest and -highest means bound it."""
    runs = scores(spark, d).groupBy("system", "day").agg(F.avg("score").alias("v"))
    return iv.width_table(runs, "system", "v", 1, lambda n: n - 2)


@query(with_views(QUALITY_EVAL) + """
SELECT lang, n, round(vs, 6) AS var_sampling, round(vj, 6) AS var_judge, round(bias, 6) AS bias,
  round(sqrt(vs / n + vj / n + bias * bias), 6) AS combined FROM (SELECT lang, count(*) AS n, var_samp(y_true) AS vs,
  var_samp(pred_A - y_true) AS vj, avg(pred_A - y_true) AS bias FROM v_quality_eval GROUP BY 1)""")
def uncertainty_budget(spark, d):
    return iv.uncertainty_budget(quality_eval(spark, d), ["lang"], F.col("pred_A"), F.col("y_true"))


@query(with_views(SCORES) + """
SELECT bin::INT AS bin, 1 + bin * 5e-1 AS bin_start, count(score) FILTER (system = 'A') AS n_A,
  count(score) FILTER (system = 'B') AS n_B FROM range(9) r(bin) LEFT JOIN v_scores ON floor((score - 1) / 5e-1) = bin GROUP BY bin""")
def score_histogram(spark, d):
    return iv.histogram(scores(spark, d), F.col("score"), 0.5, 1.0, 5.0, "system", ["A", "B"])

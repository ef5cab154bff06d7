"""Judges over conversation pairs, rater agreement and judge audits."""

from pyspark.sql import functions as F

from gaugeline.functions.frames import unpivot
from gaugeline.operators import agreement as ag, judging as jd
from gaugeline.plans.registry import query
from gaugeline.plans.views import PAIRS, QUALITY_EVAL, SCORES, pairs, quality_eval, scores, with_views
from gaugeline.sources.tables import table

KEYS = ["conv_id", "turn"]


def _norm(x):
    return (rf"regexp_replace(lower(rtrim(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '.,!?;:')), '\s+', ' ', 'g')")


def _strip(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


F1 = """
ta AS (SELECT conv_id, turn, t, count(*) AS a FROM (SELECT conv_id, turn,
  unnest(regexp_extract_all(lower(reply), '[a-z0-9]+')) AS t FROM v_pairs) GROUP BY ALL),
tb AS (SELECT conv_id, turn, t, count(*) AS b FROM (SELECT conv_id, turn,
  unnest(regexp_extract_all(lower(reference), '[a-z0-9]+')) AS t FROM v_pairs) GROUP BY ALL),
ov AS (SELECT conv_id, turn, sum(least(a, b)) AS o FROM ta JOIN tb USING (conv_id, turn, t) GROUP BY ALL),
v_f1 AS (SELECT p.conv_id, p.turn, coalesce(o, 0)::BIGINT AS overlap,
    len(regexp_extract_all(lower(reply), '[a-z0-9]+')) AS n_reply,
    len(regexp_extract_all(lower(reference), '[a-z0-9]+')) AS n_reference,
    CASE WHEN coalesce(o, 0) = 0 THEN 0e0 ELSE
      2 * (o / n_reply::DOUBLE) * (o / n_reference::DOUBLE) / (o / n_reply::DOUBLE + o / n_reference::DOUBLE) END AS f1
  FROM v_pairs p LEFT JOIN ov USING (conv_id, turn))"""

VERDICTS = """
v_verdict AS (SELECT conv_id, turn, n_reply, f1,
  CASE WHEN f1 + 25e-2 * b >= 75e-2 THEN 1 ELSE 0 END AS strict,
  CASE WHEN f1 + b >= 45e-2 THEN 1 ELSE 0 END AS lenient,
  CASE WHEN f1 + 6e-1 * b >= 85e-2 THEN 5 WHEN f1 + 6e-1 * b >= 65e-2 THEN 4
       WHEN f1 + 6e-1 * b >= 45e-2 THEN 3 WHEN f1 + 6e-1 * b >= 2e-1 THEN 2 ELSE 1 END AS scale_1_5
  FROM (SELECT *, least(2e-1, 12e-3 * n_reply) AS b FROM v_f1))"""

LONG = """
v_long AS (SELECT conv_id, turn, judge, score FROM (
  SELECT p.conv_id, p.turn,
    CASE WHEN """ + _strip("reply") + " = " + _strip("reference") + """ THEN 1e0 ELSE 0e0 END AS exact,
    CASE WHEN """ + _norm("reply") + " = " + _norm("reference") + """ THEN 1e0 ELSE 0e0 END AS normalised,
    f1 AS token_overlap, CASE WHEN f1 >= 5e-1 THEN 1e0 ELSE 0e0 END AS overlap_match,
    strict::DOUBLE AS strict, lenient::DOUBLE AS lenient, scale_1_5::DOUBLE AS scale_1_5
  FROM v_pairs p JOIN v_verdict v USING (conv_id, turn))
  UNPIVOT (score FOR judge IN (exact, normalised, token_overlap, overlap_match, strict, lenient, scale_1_5)))"""


def verdicts(spark, d):
    """One row per pair with the verdict of every judge."""
    p = pairs(spark, d).select(
        *KEYS, "reply", "reference", jd.exact_match(F.col("reply"), F.col("reference")).alias("exact"),
        jd.normalised_match(F.col("reply"), F.col("reference")).alias("normalised"))
    # The flags ride along as grouping columns, so the pairs are read once and
    # the texts stay behind.
    rows = jd.token_overlap(p, [*KEYS, "exact", "normalised"])
    rows = rows.withColumns(jd.rubric_scores(F.col("token_f1"), F.col("n_reply")))
    return rows.withColumn("overlap_match", (F.col("token_f1") >= 0.5).cast("int"))


JUDGES = {"exact": "exact", "normalised": "normalised", "token_overlap": "token_f1",
          "overlap_match": "overlap_match", "strict": "strict", "lenient": "lenient", "scale_1_5": "scale_1_5"}


def long_verdicts(spark, d):
    return unpivot(verdicts(spark, d), KEYS, {k: F.col(c) for k, c in JUDGES.items()}, "judge", "score")


@query(with_views(PAIRS) + f"""
SELECT conv_id, turn, CASE WHEN {_strip('reply')} = {_strip('reference')} THEN 1 ELSE 0 END AS exact,
  CASE WHEN {_norm('reply')} = {_norm('reference')} THEN 1 ELSE 0 END AS normalised FROM v_pairs""")
def judge_programmatic(spark, d):
    return pairs(spark, d).select(
        *KEYS, jd.exact_match(F.col("reply"), F.col("reference")).alias("exact"),
        jd.normalised_match(F.col("reply"), F.col("reference")).alias("normalised"))


@query(with_views(PAIRS, F1) + """
SELECT conv_id, turn, overlap, n_reply, n_reference, round(f1, 6) AS token_f1 FROM v_f1""")
def judge_token_f1(spark, d):
    return jd.token_overlap(pairs(spark, d), KEYS)


@query(with_views(PAIRS, F1, VERDICTS) + """
SELECT conv_id, turn, strict, lenient, scale_1_5 FROM v_verdict""")
def judge_rubrics(spark, d):
    return verdicts(spark, d).select(*KEYS, "strict", "lenient", "scale_1_5")


# Answers derived from part names: shouted, wrapped in a sentence, cut, unknown, or signs only.
QA = """
qa AS (SELECT p_partkey AS id, p_name AS reference, CASE p_partkey % 5
  WHEN 0 THEN upper(p_name) || ' .' WHEN 1 THEN 'It is a ' || p_name || '!'
  WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN 'unknown' ELSE '???' END AS answer FROM part)"""


def qa_table(spark, d):
    p = table(spark, d, "part")
    name, kind = F.col("p_name"), F.col("p_partkey") % 5
    answer = (F.when(kind == 0, F.concat(F.upper(name), F.lit(" .")))
              .when(kind == 1, F.concat(F.lit("It is a "), name, F.lit("!")))
              .when(kind == 2, F.split_part(name, F.lit(" "), F.lit(1)))
              .when(kind == 3, "unknown").otherwise("???"))
    return p.select(F.col("p_partkey").alias("id"), name.alias("reference"), answer.alias("answer"))


@query(with_views(QA, f"n AS (SELECT id, {_norm('answer')} AS a, {_norm('reference')} AS r FROM qa)") + r"""
SELECT id, CASE WHEN a = r THEN 1 ELSE 0 END AS strict, CASE WHEN contains(a, r) THEN 1 ELSE 0 END AS lenient,
  CASE WHEN a = r THEN 5 WHEN contains(a, r) THEN 4
    WHEN len(list_intersect(list_filter(string_split(a, ' '), lambda w: w <> ''), list_filter(string_split(r, ' '), lambda w: w <> ''))) > 0 THEN 3
    WHEN regexp_matches(a, '\p{L}') THEN 2 ELSE 1 END AS scale_1_5 FROM n""")
def judge_qa(spark, d):
    cols = jd.qa_scores(F.col("answer"), F.col("reference"))
    return qa_table(spark, d).select("id", *[c.alias(n) for n, c in cols.items()])


@query(with_views(QA, f"n AS (SELECT id, {_norm('answer')} AS a, {_norm('reference')} AS r FROM qa)") + """
SELECT id, rerun::INT AS rerun, judge, score FROM (SELECT id, rerun, CASE WHEN a = r THEN 1e0 ELSE 0e0 END AS qa_strict,
  CASE WHEN contains(a, r) THEN 1e0 ELSE 0e0 END AS qa_lenient FROM n, range(3) x(rerun))
UNPIVOT (score FOR judge IN (qa_strict, qa_lenient))""")
def judge_long(spark, d):
    """Registered judges over a table with re-runs."""
    reg = jd.JudgeRegistry()
    reg.register("qa_strict", "binary", lambda a, r: jd.qa_scores(a, r)["strict"])
    reg.register("qa_lenient", "binary", lambda a, r: jd.qa_scores(a, r)["lenient"])
    return reg.run(qa_table(spark, d), ["id"], n_reruns=3, reply="answer")


@query(with_views(PAIRS, F1, VERDICTS, LONG) + """
SELECT judge, count(*) AS n, round(avg(score), 3) AS headline FROM v_long GROUP BY judge""")
def judge_headline(spark, d):
    return long_verdicts(spark, d).groupBy("judge").agg(
        F.count("*").alias("n"), F.round(F.avg("score"), 3).alias("headline"))


@query(with_views(PAIRS, F1, VERDICTS) + """
SELECT conv_id, turn, strict, lenient, scale_1_5 FROM v_verdict WHERE strict IS DISTINCT FROM lenient""")
def judge_disagreements(spark, d):
    return verdicts(spark, d).where(~F.col("strict").eqNullSafe(F.col("lenient"))).select(
        *KEYS, "strict", "lenient", "scale_1_5")


def _slice(col):
    return F.when(F.col(col) < 30, "short").when(F.col(col) < 80, "medium").otherwise("long")


@query(with_views(PAIRS, F1, VERDICTS, LONG) + """
SELECT judge, round(avg(score) FILTER (n_reply < 30), 6) AS short_score,
  round(avg(score) FILTER (n_reply >= 30 AND n_reply < 80), 6) AS medium_score,
  round(avg(score) FILTER (n_reply >= 80), 6) AS long_score
FROM v_long JOIN v_f1 USING (conv_id, turn) GROUP BY judge""")
def judge_sensitivity_grid(spark, d):
    v = verdicts(spark, d).withColumn("slice", _slice("n_reply"))
    long = unpivot(v, ["slice"], {k: F.col(c) for k, c in JUDGES.items()}, "judge", "score")
    return jd.sensitivity_grid(long, "judge", "slice", ["short", "medium", "long"], "score")


@query(with_views(PAIRS, F1, VERDICTS, LONG) + """
SELECT count(*) AS n, count(*) FILTER (l.score = 1 AND e.score = 0) AS trapped,
  round(avg(CASE WHEN l.score = 1 AND e.score = 0 THEN 1e0 ELSE 0e0 END), 6) AS trap_share
FROM (SELECT * FROM v_long WHERE judge = 'lenient') l JOIN (SELECT * FROM v_long WHERE judge = 'exact') e USING (conv_id, turn)""")
def exact_match_trap(spark, d):
    trap = (F.col("lenient") == 1) & (F.col("exact") == 0)
    return verdicts(spark, d).agg(
        F.count("*").alias("n"), F.count_if(trap).alias("trapped"), F.avg(trap.cast("double")).alias("trap_share"))


RATERS = """
v_raters AS (SELECT doc_id, lang, y_true AS r1, 1 - toxic AS r2, pred_A AS r3 FROM v_quality_eval)"""


def raters(spark, d):
    return quality_eval(spark, d).select(
        "doc_id", "lang", F.col("y_true").alias("r1"), (1 - F.col("toxic")).alias("r2"), F.col("pred_A").alias("r3"))


KAPPA = "CASE WHEN pe = 1 THEN CASE WHEN po = 1 THEN 1e0 ELSE 0e0 END ELSE (po - pe) / (1 - pe) END"


def _pair(a, b, by=""):
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""SELECT {lead}'{a}' AS rater_1, '{b}' AS rater_2, n, po AS agreement, {KAPPA} AS kappa FROM (
  SELECT *, pa * pb + (1 - pa) * (1 - pb) AS pe FROM (SELECT {lead}count(*) AS n,
    avg(CASE WHEN {a} = {b} THEN 1e0 ELSE 0e0 END) AS po, avg({a}) AS pa, avg({b}) AS pb FROM v_raters{tail}))"""


@query(with_views(QUALITY_EVAL, RATERS) + """
SELECT count(*) AS n, round(avg(CASE WHEN r1 = r2 THEN 1e0 ELSE 0e0 END), 6) AS agreement FROM v_raters""")
def rater_agreement(spark, d):
    return raters(spark, d).agg(F.count("*").alias("n"), F.avg((F.col("r1") == F.col("r2")).cast("double")).alias("agreement"))


def rater_columns():
    return {r: F.col(r) for r in ("r1", "r2", "r3")}


@query(with_views(QUALITY_EVAL, RATERS) + "SELECT rater_1, rater_2, n, round(agreement, 6) AS agreement, round(kappa, 6) AS kappa FROM ("
       + " UNION ALL ".join(_pair(*p) for p in (("r1", "r2"), ("r1", "r3"), ("r2", "r3"))) + ")")
def rater_kappa(spark, d):
    return ag.agreement_pairs(raters(spark, d), rater_columns())


@query(with_views(QUALITY_EVAL, RATERS) + "SELECT lang, rater_1, rater_2, n, round(agreement, 6) AS agreement, round(kappa, 6) AS kappa FROM ("
       + " UNION ALL ".join(_pair(*p, by="lang") for p in (("r1", "r2"), ("r1", "r3"), ("r2", "r3"))) + ")")
def kappa_matrix(spark, d):
    return ag.agreement_pairs(raters(spark, d), rater_columns(), by=["lang"])


@query(with_views(QUALITY_EVAL, RATERS) + """
SELECT doc_id, 3 AS n_raters, round((r1 + r2 + r3) / 3e0, 6) AS mean_vote,
  CASE WHEN r1 + r2 + r3 >= 2 THEN 1 ELSE 0 END AS majority, (r1 + r2 + r3) IN (1, 2) AS contested FROM v_raters""")
def pooled_labels(spark, d):
    votes = ag.pooled(F.array(*rater_columns().values()))
    return raters(spark, d).select("doc_id", *[c.alias(n) for n, c in votes.items()])


@query(with_views(QUALITY_EVAL, """
g AS (SELECT * FROM v_quality_eval WHERE y_true = 1),
e AS (SELECT quantile_cont(n_chars, 25e-2) AS e1, quantile_cont(n_chars, 5e-1) AS e2, quantile_cont(n_chars, 75e-2) AS e3 FROM g),
b AS (SELECT g.*, (n_chars > e1)::INT + CASE WHEN e2 > e1 THEN (n_chars > e2)::INT ELSE 0 END
  + CASE WHEN e3 > e2 THEN (n_chars > e3)::INT ELSE 0 END AS length_bin FROM g, e)""") + """
SELECT length_bin, count(*) AS n, round(avg(n_chars), 6) AS mean_len, round(avg(toxic), 6) AS mean_score,
  round(avg(y_true), 6) AS mean_quality FROM b GROUP BY 1""")
def verbosity_curve(spark, d):
    return ag.verbosity_curve(quality_eval(spark, d), "n_chars", "toxic", "y_true", 4)


@query(with_views(QUALITY_EVAL, """
l AS (SELECT 'A' AS judge, pred_A AS score, y_true FROM v_quality_eval UNION ALL
  SELECT 'B', pred_B, y_true FROM v_quality_eval UNION ALL SELECT 'not_toxic', 1 - toxic, y_true FROM v_quality_eval)""") + """
SELECT judge, count(*) AS n, round(avg(score - y_true), 6) AS bias, round(stddev_samp(score - y_true), 6) AS noise,
  round(avg(abs(score - y_true)), 6) AS mean_abs_error FROM l GROUP BY 1""")
def judge_bias_noise(spark, d):
    long = unpivot(quality_eval(spark, d), ["y_true"], {
        "A": F.col("pred_A"), "B": F.col("pred_B"), "not_toxic": 1 - F.col("toxic")}, "judge", "score")
    return ag.bias_and_noise(long, "judge", "score", "y_true")


SPREAD = """
sp AS (SELECT user_id, count(*) AS n, avg(score) AS mean, stddev_samp(score) AS std, min(score) AS lo, max(score) AS hi
  FROM v_scores GROUP BY 1)"""


@query(with_views(SCORES, SPREAD) + """
SELECT user_id, n, round(mean, 6) AS mean, round(std, 6) AS std, lo AS min, hi AS max FROM sp""")
def rerun_spread(spark, d):
    return ag.rerun_spread(scores(spark, d), "user_id", "score")


@query(with_views(SCORES, SPREAD) + """
SELECT count(*) AS items, round(sum((n - 1) * std * std) / nullif(sum(n - 1) FILTER (std IS NOT NULL), 0), 6) AS within_var,
  round(var_samp(mean), 6) AS between_var FROM sp""")
def rerun_variance_split(spark, d):
    return ag.variance_split(ag.rerun_spread(scores(spark, d), "user_id", "score"))


@query(with_views(QUALITY_EVAL, """
c AS (SELECT lang, count(*) AS n, sum(toxic) AS flagged, sum(1 - y_true) AS bad, sum(toxic * (1 - y_true)) AS tf
  FROM v_quality_eval GROUP BY 1),
r AS (SELECT *, bad / n::DOUBLE AS base, tf / nullif(bad, 0)::DOUBLE AS catch, (flagged - tf) / nullif(n - bad, 0)::DOUBLE AS ff FROM c)""") + """
SELECT lang, n, flagged::BIGINT AS flagged, bad::BIGINT AS bad, tf::BIGINT AS true_flags, round(base, 6) AS base_rate,
  round(catch, 6) AS catch_rate, round(ff, 6) AS false_flag_rate, round(tf / nullif(flagged, 0)::DOUBLE, 6) AS p_bad_given_flag,
  round(base * catch / nullif(base * catch + (1 - base) * ff, 0), 6) AS p_bad_by_bayes FROM r""")
def flag_reliability(spark, d):
    return ag.flag_reliability(quality_eval(spark, d), F.col("toxic") == 1, F.col("y_true") == 0, by=["lang"])


@query(with_views(PAIRS, F1, VERDICTS, LONG) + """
SELECT conv_id, turn, max(score) - min(score) AS spread, count(DISTINCT score)::INT AS n_verdicts FROM v_long
WHERE judge IN ('exact', 'normalised', 'overlap_match', 'strict', 'lenient') GROUP BY ALL""")
def judge_spread_no_truth(spark, d):
    names = ("exact", "normalised", "overlap_match", "strict", "lenient")
    return ag.spread_without_truth(verdicts(spark, d), KEYS, {n: F.col(n) for n in names})


@query(with_views(PAIRS, """
l AS (SELECT length(reply) AS a, length(reference) AS b, (length(reply) + length(reference)) // 200 AS size_class FROM v_pairs),
v AS (SELECT least(size_class, 5)::INT AS size_class, CASE WHEN b > a + 40 THEN 'reference' ELSE 'reply' END AS v1,
  CASE WHEN a > b + 40 THEN 'reply' ELSE 'reference' END AS v2 FROM l)""") + """
SELECT size_class, count(*) AS n, sum((v1 <> v2)::INT)::BIGINT AS flips, round(avg((v1 <> v2)::INT), 6) AS flip_rate FROM v GROUP BY 1""")
def position_bias(spark, d):
    """A length judge that keeps the first answer unless the second is clearly longer."""
    a, b = F.char_length("reply"), F.char_length("reference")
    rows = pairs(spark, d).select(
        F.least(F.floor((a + b) / 200), F.lit(5)).cast("int").alias("size_class"),
        F.when(b > a + 40, "reference").otherwise("reply").alias("v1"),
        F.when(a > b + 40, "reply").otherwise("reference").alias("v2"))
    return ag.order_swap_flips(rows, ["size_class"], F.col("v1"), F.col("v2"))

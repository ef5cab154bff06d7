"""Classification reports, splits, draws and resampling on the given tables."""

from pyspark.sql import functions as F

from gaugeline.functions.frames import unpivot, with_grid
from gaugeline.operators import classify as cl, ranks as rk, sampling as sp
from gaugeline.plans.registry import query, report_sql, u_sql
from gaugeline.plans.views import (
    LANG_EVAL, LANGS, QUALITY_EVAL, lang_eval, lang_eval_frame, quality_eval, with_views)
from gaugeline.sources.tables import stored, table

COUNTS = """
cf AS (SELECT y_true, coalesce(y_pred, '∅') AS y_pred, count(*) AS n FROM v_lang_eval GROUP BY 1, 2)"""


@query("""SELECT lang AS class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
          FROM documents GROUP BY 1""")
def class_distribution(spark, d):
    return cl.class_distribution(table(spark, d, "documents"), "lang")


@query(with_views(LANG_EVAL, COUNTS) + " SELECT y_true, y_pred, n FROM cf")
def confusion_long(spark, d):
    return cl.confusion(lang_eval(spark, d))


@query(with_views(LANG_EVAL, COUNTS) + " SELECT y_true, " + ", ".join(
    f"coalesce(sum(n) FILTER (y_pred = '{v}'), 0)::BIGINT AS pred_{k}"
    for v, k in [*[(c, c) for c in LANGS], ("∅", "none")]) + " FROM cf GROUP BY 1")
def confusion_wide(spark, d):
    return cl.confusion_wide(cl.confusion(lang_eval(spark, d)), LANGS)


@query(with_views(LANG_EVAL, COUNTS, report_sql("cf")) + """
SELECT class, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
  tp + fn AS support FROM report""")
def classification_report(spark, d):
    return cl.per_class(cl.confusion(lang_eval(spark, d)))


SUMMARY = """
  (SELECT round(coalesce(avg(p), 0), 6) FROM report) AS macro_precision,
  (SELECT round(coalesce(avg(r), 0), 6) FROM report) AS macro_recall,
  (SELECT round(coalesce(avg(f), 0), 6) FROM report) AS macro_f1"""


@query(with_views(LANG_EVAL, COUNTS, report_sql("cf")) + f"""
SELECT sum(n)::BIGINT AS n, sum(n) FILTER (y_true = y_pred)::BIGINT AS correct,
  round(sum(n) FILTER (y_true = y_pred) / sum(n), 6) AS accuracy, {SUMMARY} FROM cf""")
def classification_summary(spark, d):
    return cl.summary(cl.confusion(lang_eval(spark, d)))


@query("""
WITH top AS (SELECT lang FROM documents GROUP BY 1 ORDER BY count(*) DESC, lang LIMIT 1),
cf AS (SELECT d.lang AS y_true, t.lang AS y_pred, count(*) AS n FROM documents d, top t GROUP BY 1, 2),
""" + report_sql("cf").lstrip() + f"""
SELECT (SELECT lang FROM top) AS top_class, sum(n)::BIGINT AS n,
  sum(n) FILTER (y_true = y_pred)::BIGINT AS correct,
  round(sum(n) FILTER (y_true = y_pred) / sum(n), 6) AS accuracy, {SUMMARY} FROM cf""")
def majority_baseline_eval(spark, d):
    docs = table(spark, d, "documents").select(F.col("lang").alias("y_true"))
    rows = cl.with_majority_prediction(docs, docs)
    top = cl.majority_class(docs).select("top_class").scalar()
    return cl.summary(cl.confusion(rows)).withColumn("top_class", top)


@query(with_views(QUALITY_EVAL, """
long AS (SELECT 'A' AS model, y_true::VARCHAR AS y_true, pred_A::VARCHAR AS y_pred FROM v_quality_eval
  UNION ALL SELECT 'B', y_true::VARCHAR, pred_B::VARCHAR FROM v_quality_eval),
cf AS (SELECT model, y_true, y_pred, count(*) AS n FROM long GROUP BY ALL)""", report_sql("cf", "model")) + """
SELECT class, max(tp + fn)::BIGINT AS support,
  round(max(r) FILTER (model = 'A'), 6) AS A_recall, round(max(f) FILTER (model = 'A'), 6) AS A_f1,
  round(max(r) FILTER (model = 'B'), 6) AS B_recall, round(max(f) FILTER (model = 'B'), 6) AS B_f1
FROM report GROUP BY class""")
def model_compare_per_class(spark, d):
    q = quality_eval(spark, d)
    long = unpivot(q, ["y_true"], {"A": F.col("pred_A"), "B": F.col("pred_B")}, "model", "y_pred")
    counts = cl.confusion(long.withColumn("y_pred", F.col("y_pred").cast("int")), by=["model"])
    return cl.compare_models(counts, ["A", "B"])


@query(f"SELECT doc_id, CASE WHEN {u_sql('doc_id', chr(39) + 'split' + chr(39))} < 7e-1 THEN 'train' ELSE 'test' END AS split FROM documents")
def split_hash(spark, d):
    return sp.hash_split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.7, "split")


@query("""
WITH r AS (SELECT doc_id, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('pool:' || doc_id::VARCHAR)) AS i
  FROM documents)
SELECT doc_id, CASE WHEN i <= greatest(least(1000, n - 200), 0) THEN 'pool' ELSE 'train' END AS role FROM r""")
def holdout_pool(spark, d):
    return sp.holdout(table(spark, d, "documents").select("doc_id"), "doc_id", 1000, "pool")


_ROLE_U = u_sql("doc_id", "'roles:' || lang")


@query(f"""
WITH r AS (SELECT doc_id, lang, {_ROLE_U} AS u FROM documents),
s AS (SELECT doc_id, lang, CASE WHEN u < 4e-1 THEN 'dev' WHEN u < 4e-1 + 2e-1 THEN 'validation'
  WHEN u < 4e-1 + 2e-1 + 3e-1 THEN 'test' ELSE 'calibration' END AS role FROM r)
SELECT doc_id, lang, role, role = 'test' AS sealed FROM s""")
def split_stratified(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return sp.stratified_roles(
        docs, "doc_id", "lang", {"dev": 0.4, "validation": 0.2, "test": 0.3, "calibration": 0.1}, "roles")


@query(with_views(LANG_EVAL, """
pick AS (SELECT * FROM v_lang_eval ORDER BY md5('0:' || doc_id::VARCHAR) LIMIT 150),
cf AS (SELECT y_true, coalesce(y_pred, '∅') AS y_pred, count(*) AS n FROM pick GROUP BY 1, 2)""",
                  report_sql("cf")) + f"""
SELECT 0 AS seed, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (y_true = y_pred), 0)::BIGINT AS correct,
  round(coalesce(sum(n) FILTER (y_true = y_pred), 0) / sum(n), 6) AS accuracy, {SUMMARY} FROM cf""")
def resample_once(spark, d):
    rows = drawn_docs(spark, d, 150, [0])
    return cl.summary(cl.confusion(rows, by=["seed"]), by=["seed"])


def drawn_docs(spark, d, n, seeds):
    """Draw first, then predict only the drawn documents.

    The draw needs keys alone.  It is written out, so Spark knows how short it is
    and broadcasts it: the texts of all other rows are neither shuffled nor
    tokenised.
    """
    ids = table(spark, d, "documents").select("doc_id")
    draws = stored(sp.draw(ids, "doc_id", n, seeds), "draws")
    return draws.join(lang_eval_of(spark, d, draws), "doc_id")


def lang_eval_of(spark, d, draws):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return lang_eval_frame(docs.join(draws.select("doc_id").distinct(), "doc_id", "left_semi"))


SPREAD_SQL = """
rk AS (SELECT s.seed, v.*, row_number() OVER (PARTITION BY s.seed ORDER BY md5(s.seed::VARCHAR || ':' || doc_id::VARCHAR)) AS i
  FROM v_lang_eval v, range(40) s(seed)),
pick AS (SELECT * FROM rk WHERE i <= 150),
val AS (SELECT seed, 'accuracy' AS metric, avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END) AS v FROM pick GROUP BY 1
  UNION ALL SELECT seed, 'recall_' || y_true, avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END) FROM pick GROUP BY seed, y_true)"""


@query(with_views(LANG_EVAL, SPREAD_SQL) + """
SELECT metric, count(*) AS draws, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  round(min(v), 6) AS min, round(max(v), 6) AS max FROM val GROUP BY metric""")
def resample_spread(spark, d):
    rows = drawn_docs(spark, d, 150, range(40))
    return spread_of(cl.confusion(rows, by=["seed"]))


def spread_of(counts):
    """Spread over the seeds of accuracy and recall per class."""
    right = F.col("y_true") == F.col("y_pred")
    hit = F.sum(F.when(right, F.col("n")).otherwise(0))
    # accuracy and per-class recall of every draw from one small grouping
    sets = counts.groupingSets([["seed"], ["seed", "y_true"]], "seed", "y_true").agg(
        (hit / F.sum("n")).alias("v"), F.grouping("y_true").alias("g"))
    name = F.when(F.col("g") == 1, "accuracy").otherwise(F.concat(F.lit("recall_"), F.col("y_true")))
    return sets.groupBy(name.alias("metric")).agg(
        F.count("*").alias("draws"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))


SKEWS = [0.0, 0.3, 0.6, 0.9]
_SKEW_U = u_sql("doc_id", "'skew:' || round(skew * 100)::INT::VARCHAR")


@query(with_views(LANG_EVAL, f"""
top AS (SELECT y_true AS c FROM v_lang_eval GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
g AS (SELECT v.*, skew, CASE WHEN y_true = (SELECT c FROM top) THEN 1e0 ELSE greatest(1e-3, 1 - skew) END AS w
  FROM v_lang_eval v, (VALUES (0e0), (3e-1), (6e-1), (9e-1)) k(skew)),
x AS (SELECT *, 500 * w / sum(w) OVER (PARTITION BY skew) AS want, {_SKEW_U} AS u FROM g),
y AS (SELECT *, want - floor(want) AS f, 500 - sum(floor(want)) OVER (PARTITION BY skew) AS places FROM x),
dr AS (SELECT *, floor(want)::BIGINT + CASE WHEN f > 0 AND row_number() OVER (PARTITION BY skew, f > 0 ORDER BY u * (1 - f) / (f * (1 - u)), doc_id) <= places
  THEN 1 ELSE 0 END AS copies FROM y),
m AS (SELECT skew, 'rules' AS model, y_true, coalesce(y_pred, '∅') AS y_pred, copies FROM dr WHERE copies > 0
  UNION ALL SELECT skew, 'majority', y_true, (SELECT c FROM top), copies FROM dr WHERE copies > 0),
cf AS (SELECT skew, model, y_true, y_pred, sum(copies) AS n FROM m GROUP BY ALL)""", report_sql("cf", "skew,model")) + """
SELECT c.skew, c.model, c.n::BIGINT AS n, round(c.acc, 6) AS accuracy, round(r.mr, 6) AS macro_recall FROM
  (SELECT skew, model, sum(n) AS n, coalesce(sum(n) FILTER (y_true = y_pred), 0) / sum(n) AS acc FROM cf GROUP BY ALL) c
  JOIN (SELECT skew, model, avg(r) AS mr FROM report GROUP BY ALL) r USING (skew, model)""")
def skew_sweep(spark, d):
    """Rules and majority baseline on ever more lopsided draws."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    draws = stored(sp.skewed_copies(docs, "doc_id", "lang", 500, SKEWS, "skew"), "draws")
    rows = draws.select("doc_id", "skew", "copies", "top").join(lang_eval_of(spark, d, draws), "doc_id")
    preds = F.array(F.struct(F.lit("rules").alias("model"), F.col("y_pred").alias("p")),
                    F.struct(F.lit("majority").alias("model"), F.col("top").alias("p")))
    long = rows.select("skew", "copies", "y_true", F.explode(preds).alias("m"))
    counts = long.groupBy(
        "skew", F.col("m.model").alias("model"), "y_true",
        F.coalesce("m.p", F.lit(cl.NO_ANSWER)).alias("y_pred")).agg(F.sum("copies").alias("n"))
    return cl.summary(counts, by=["skew", "model"]).select("skew", "model", "n", "accuracy", "macro_recall")


@query(f"""
WITH top AS (SELECT lang AS c FROM documents GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
g AS (SELECT doc_id, lang, skew, CASE WHEN lang = (SELECT c FROM top) THEN 1e0 ELSE greatest(1e-3, 1 - skew) END AS w, {_SKEW_U} AS u
  FROM documents, (VALUES (0e0), (3e-1), (6e-1), (9e-1)) k(skew)),
r AS (SELECT *, row_number() OVER (PARTITION BY skew ORDER BY -ln(1 - u) / w, doc_id) AS i FROM g)
SELECT skew, lang, count(*) AS n FROM r WHERE i <= 500 GROUP BY ALL""")
def skew_draw(spark, d):
    """Class counts of draws of exactly 500 without replacement, ever more lopsided."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return sp.skewed_draw(docs, "doc_id", "lang", 500, SKEWS, "skew").groupBy("skew", "lang").agg(F.count("*").alias("n"))


_PICK_U = u_sql("('pick:' || seed::VARCHAR || ':' || j::VARCHAR)", "'replace'")


@query(with_views(LANG_EVAL, f"""
nr AS (SELECT *, row_number() OVER (ORDER BY md5('replace:' || doc_id::VARCHAR), doc_id) - 1 AS pos FROM v_lang_eval),
pk AS (SELECT seed, floor({_PICK_U} * (SELECT count(*) FROM documents)) AS pos FROM range(10) s(seed), range(150) k(j)),
dr AS (SELECT seed, y_true, y_pred FROM pk JOIN nr USING (pos))""") + """
SELECT seed::INT AS seed, count(*) AS n, round(avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM dr GROUP BY 1""")
def resample_replace(spark, d):
    """Accuracy of ten draws of 150 with replacement; only drawn documents are predicted."""
    ids = table(spark, d, "documents").select("doc_id")
    draws = stored(sp.draw_replace(ids, "doc_id", 150, range(10)), "draws")
    rows = draws.join(lang_eval_of(spark, d, draws), "doc_id")
    right = F.col("y_true") == F.col("y_pred")
    return rows.groupBy("seed").agg(F.sum("copies").alias("n"), (F.sum(F.when(right, F.col("copies")).otherwise(0)) / F.sum("copies")).alias("accuracy"))


@query(with_views(QUALITY_EVAL, """
rk AS (SELECT k.n, s.seed, v.y_true, row_number() OVER (PARTITION BY k.n, s.seed
    ORDER BY md5(s.seed::VARCHAR || ':' || doc_id::VARCHAR)) AS i
  FROM v_quality_eval v, range(40) s(seed), (VALUES (20), (50), (200)) k(n)),
m AS (SELECT n, seed, avg(y_true) AS v FROM rk WHERE i <= n GROUP BY ALL)""") + """
SELECT n, count(*) AS draws, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std_error FROM m GROUP BY n""")
def spread_by_n(spark, d):
    """Standard error of a mean against the sample size."""
    q = table(spark, d, "labels").select("doc_id", "quality")
    q = q.join(table(spark, d, "documents").select("doc_id"), "doc_id", "left_semi")
    rows = with_grid(sp.draw(q, "doc_id", 200, range(40)), "n", [20, 50, 200]).where("draw_rank <= n")
    means = rows.groupBy("n", "seed").agg(F.avg("quality").alias("v"))
    return means.groupBy("n").agg(
        F.count("*").alias("draws"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std_error"))


def ranked_draw_sql(n: int, seeds: int, total: str) -> str:
    """Views nr (doc_id, pos) and picks (seed, place, pos): the draws by rank of ``draw_by_rank`` for any size of the table."""
    u = "(('0x' || substr(md5('rank:' || {0}), 1, 13))::BIGINT / 4503599627370496e0)"
    tried, order = u.format("seed::VARCHAR || ':' || j::VARCHAR"), u.format("'order:' || seed::VARCHAR || ':' || pos::VARCHAR")
    return f"""
nn AS (SELECT total, least({n}, total) AS size, CASE WHEN 2 * least({n}, total) <= total THEN least({n}, total) ELSE total - least({n}, total) END AS m
  FROM (SELECT count(*) AS total FROM {total})),
nr AS (SELECT *, row_number() OVER (ORDER BY md5('place:' || doc_id::VARCHAR), doc_id) - 1 AS pos FROM {total}),
ft AS (SELECT seed, floor({tried} * total)::BIGINT AS pos, min(j) AS j FROM nn, range({seeds}) s(seed), range({2 * n + 64}) k(j)
  WHERE j < 2 * m + 64 GROUP BY ALL),
dw AS (SELECT seed, pos, row_number() OVER (PARTITION BY seed ORDER BY j) AS place FROM ft),
cm AS (SELECT seed, pos FROM nr, range({seeds}) s(seed) WHERE NOT EXISTS (
  SELECT 1 FROM dw, nn WHERE dw.seed = s.seed AND dw.pos = nr.pos AND place <= m)),
picks AS (SELECT seed, place, pos FROM dw, nn WHERE 2 * size <= total AND place <= m
  UNION ALL SELECT seed, row_number() OVER (PARTITION BY seed ORDER BY {order}, pos), pos FROM cm, nn WHERE 2 * size > total)"""


@query(with_views(LANG_EVAL, ranked_draw_sql(150, 40, "documents"), """
pick AS (SELECT seed, y_true, y_pred FROM picks JOIN nr USING (pos) JOIN v_lang_eval USING (doc_id)),
val AS (SELECT seed, 'accuracy' AS metric, avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END) AS v FROM pick GROUP BY 1
  UNION ALL SELECT seed, 'recall_' || y_true, avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END) FROM pick GROUP BY seed, y_true)""") + """
SELECT metric, count(*) AS draws, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  round(min(v), 6) AS min, round(max(v), 6) AS max FROM val GROUP BY metric""")
def resample_spread_ranked(spark, d):
    """As ``resample_spread``, from draws that look up their ranks in a directory written once for all seeds."""
    ranks = rk.rank_directory(table(spark, d, "documents").select("doc_id"), "doc_id", "place")
    draws = stored(rk.draw_by_rank(ranks, 150, range(40)), "draws")
    return spread_of(cl.confusion(draws.join(lang_eval_of(spark, d, draws), "doc_id"), by=["seed"]))


@query("WITH q AS (SELECT doc_id, quality FROM labels SEMI JOIN documents USING (doc_id))," + ranked_draw_sql(200, 40, "q") + """,
m AS (SELECT k.n AS n, seed, avg(quality) AS v FROM picks JOIN nr USING (pos), (VALUES (20), (50), (200)) k(n) WHERE place <= k.n GROUP BY ALL)
SELECT n, count(*) AS draws, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std_error FROM m GROUP BY n""")
def spread_by_n_ranked(spark, d):
    """Standard error of a mean against the sample size, from draws by rank."""
    q = table(spark, d, "labels").select("doc_id", "quality")
    q = q.join(table(spark, d, "documents").select("doc_id"), "doc_id", "left_semi")
    draws = stored(rk.draw_by_rank(rk.rank_directory(q, "doc_id", "place"), 200, range(40)), "draws")
    rows = with_grid(draws.join(q, "doc_id"), "n", [20, 50, 200]).where("place <= n")
    means = rows.groupBy("n", "seed").agg(F.avg("quality").alias("v"))
    return means.groupBy("n").agg(
        F.count("*").alias("draws"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std_error"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS batch FROM documents")
def batch_assign(spark, d):
    """Documents in running batches of 20."""
    return sp.batches(table(spark, d, "documents").select("doc_id"), "doc_id", 20)


@query("""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('mix:' || doc_id::VARCHAR), doc_id) AS i
  FROM documents)
SELECT doc_id, lang FROM r WHERE i <= CASE lang WHEN 'en' THEN 40 WHEN 'fr' THEN 30 WHEN 'de' THEN 20 ELSE 10 END""")
def stratified_resample(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return sp.quota_sample(docs, "doc_id", "lang", {"en": 40, "fr": 30, "de": 20, "es": 10}, "mix")


@query("""SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20""")
def top_n(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)

"""Vocabulary, TF-IDF, linear scoring, nearest examples, maps and leakage."""

from pyspark.sql import Window, functions as F

from gaugeline.functions import text as tx
from gaugeline.functions.frames import side_by_side
from gaugeline.operators import classify as cl, leakage as lk, learned as ln, nearest as nb, sampling as sp, textvec as tv, vector_index as vi
from gaugeline.plans.registry import query, report_sql, u_sql
from gaugeline.plans.views import LANG_EVAL, LANGS, lang_eval, with_recursive, with_views
from gaugeline.sources.tables import stored, table

_MASKED = r"regexp_extract_all(regexp_replace(lower({t}), '\{{\{{.*?\}}\}}', ' ', 'g'), '[a-z0-9]+')"


_WORDS = r"regexp_extract_all(lower({t}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def tf_sql(source, key, text, name="tf", tokens=_MASKED):
    return f"""
{name} AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({tokens.format(t=text)}) AS term FROM {source}) GROUP BY ALL)"""


def vocab_sql(size, n_docs, tf="tf"):
    """``size`` terms at most, or all that two documents share."""
    most = f"ORDER BY df DESC, term LIMIT {size}" if size else ""
    return f"""
vb AS (SELECT term, count(*) AS df, sum(tf) AS total FROM {tf} GROUP BY 1 HAVING count(*) >= 2 {most}),
idf AS (SELECT term, df, total, ln((1e0 + {n_docs}) / (1e0 + df)) + 1 AS idf FROM vb)"""


N_DOCS = "(SELECT count(*) FROM documents)"
DOC_TF = tf_sql("documents", "doc_id", "text")


def doc_counts(spark, d):
    return tv.term_counts(table(spark, d, "documents"), "doc_id", "text")


def doc_idf(spark, d, counts, size=3000):
    n = table(spark, d, "documents").agg(F.count("*")).scalar()
    return tv.with_idf(tv.vocabulary(tv.document_frequency(counts), size), n)


@query(with_views(DOC_TF, vocab_sql(3000, N_DOCS)) + """
SELECT term, df, total::BIGINT AS total, round(idf, 6) AS idf FROM idf""")
def vocabulary_topk(spark, d):
    return doc_idf(spark, d, doc_counts(spark, d))


@query(with_views(DOC_TF, vocab_sql(3000, N_DOCS), """
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
r AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight,
    row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS rank FROM w)""") + """
SELECT doc_id, rank::INT AS rank, term, round(weight, 6) AS weight FROM r WHERE rank <= 3""")
def tfidf_topterms(spark, d):
    counts = stored(doc_counts(spark, d), "counts")  # read for the idf and for the weights
    return tv.top_terms(tv.raw_weights(counts, doc_idf(spark, d, counts), "doc_id", capped=True), "doc_id", 3)


@query(with_views(DOC_TF, vocab_sql(3000, N_DOCS), """
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term))""") + """
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf_weights(spark, d):
    """The whole normalised TF-IDF matrix as rows."""
    counts = stored(doc_counts(spark, d), "counts")  # read for the idf and for the weights
    return tv.normalised(tv.raw_weights(counts, doc_idf(spark, d, counts), "doc_id", capped=True), "doc_id")


@query(r"""
WITH t AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM conversations),
g AS (SELECT unnest(t) AS gram FROM t UNION ALL SELECT unnest([t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) FROM t)
SELECT gram, count(*) AS n FROM g GROUP BY 1""")
def ngram_counts(spark, d):
    tokens = table(spark, d, "conversations").select(tx.word_tokens(F.col("text")).alias("t"))
    grams = tokens.select(F.explode(tx.ngrams_upto(F.col("t"), 2)).alias("gram"))
    return grams.groupBy("gram").agg(F.count("*").alias("n"))


def _coef(c):
    return (f"ln((df_{c} + 1e0) / (n_{c} + 2e0)) - ln((df - df_{c} + 1e0) / (n - n_{c} + 2e0)) AS coef_{c}")


MODEL = f"""
nn AS (SELECT count(*) AS n, {", ".join(f"count(*) FILTER (lang = '{c}') AS n_{c}" for c in LANGS)} FROM documents),
sn AS (SELECT term, count(*) AS df, {", ".join(f"count(*) FILTER (lang = '{c}') AS df_{c}" for c in LANGS)}
  FROM tf JOIN vb USING (term) JOIN documents USING (doc_id) GROUP BY term),
md AS (SELECT term, {", ".join(_coef(c) for c in LANGS)} FROM sn, nn),
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
wn AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
dt AS (SELECT doc_id, {", ".join(f"sum(w * coef_{c}) AS dot_{c}" for c in LANGS)} FROM wn JOIN md USING (term) GROUP BY 1),
sc AS (SELECT lang, {", ".join(f"coalesce(dot_{c}, 0) + ln(n_{c} / n::DOUBLE) AS s_{c}" for c in LANGS)}
  FROM documents LEFT JOIN dt USING (doc_id), nn)"""
_BEST = "greatest(" + ", ".join(f"s_{c}" for c in LANGS) + ")"
_PICK = "CASE " + " ".join(f"WHEN s_{c} = {_BEST} THEN '{c}'" for c in LANGS) + " END"


@query(with_views(DOC_TF, vocab_sql(None, N_DOCS), MODEL) + f"SELECT lang AS y_true, {_PICK} AS y_pred, count(*) AS n FROM sc GROUP BY ALL")
def linear_score(spark, d):
    """Batch scoring with a stored linear model: log odds of all terms that two documents share."""
    docs = table(spark, d, "documents")
    counts = stored(tv.term_counts(docs, "doc_id", "text", keep=["lang"]), "counts")  # read for the model and for the scores
    docs = docs.select("doc_id", "lang")
    model, intercepts = tv.log_odds_model(counts, docs, "doc_id", "lang", LANGS)
    scored = tv.linear_scores_of_counts(counts, model, intercepts, "doc_id", LANGS, docs)
    return cl.confusion(scored, "lang", "y_pred")


NEAREST = f"""
qs AS (SELECT conv_id || ':' || turn AS query_id, text FROM conversations WHERE role = 'user'),""" + tf_sql(
    "benchmark", "item_id", "text", tokens=_WORDS) + "," + tf_sql("qs", "query_id", "text", "qf", _WORDS) + "," + vocab_sql(
    None, "(SELECT count(*) FROM benchmark)") + """,
ew AS (SELECT item_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
en AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM ew),
qw AS (SELECT query_id, term, tf * idf AS w FROM qf JOIN idf USING (term)),
qn AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w FROM qw),
sm AS (SELECT query_id, item_id, sum(q.w * e.w) AS similarity FROM qn q JOIN en e USING (term) GROUP BY ALL HAVING sum(q.w * e.w) > 1e-9),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC, item_id) AS rank FROM sm)"""


def nearest_frames(spark, d):
    """Normalised TF-IDF rows of user turns and of the example items."""
    items = table(spark, d, "benchmark").select("item_id", "text")
    asks = table(spark, d, "conversations").where("role = 'user'").select(
        F.concat_ws(":", "conv_id", "turn").alias("query_id"), "text")
    ec = tv.term_counts(items, "item_id", "text", tx.word_tokens)
    n = items.agg(F.count("*")).scalar()
    idf = tv.with_idf(tv.vocabulary(tv.document_frequency(ec), None), n)
    examples = tv.normalised(tv.raw_weights(ec, idf, "item_id"), "item_id")
    queries = tv.normalised(tv.raw_weights(tv.term_counts(asks, "query_id", "text", tx.word_tokens), idf, "query_id"), "query_id")
    return stored(queries, "queries"), stored(examples, "examples")


@query(with_views(NEAREST) + """
SELECT query_id, item_id, round(similarity, 6) AS similarity, rank::INT AS rank FROM rk WHERE rank <= 5""")
def nearest_example(spark, d):
    queries, examples = nearest_frames(spark, d)
    return tv.nearest_example(queries, examples, "query_id", "item_id", k=5)


CENTRES = """
ct AS (SELECT label, list(a ORDER BY i) AS c FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS a
    FROM embeddings, range(1, 65) r(i) GROUP BY ALL) GROUP BY 1),
cs AS (SELECT vec_id, e.label, embedding, ct.label AS centre_label, list_cosine_similarity(embedding::DOUBLE[], c) AS similarity
  FROM embeddings e, ct)"""


def centre_similarity(spark, d):
    e = table(spark, d, "embeddings")
    return tv.cosine_to_centres(e, tv.class_centres(e, "label", "embedding", 64), "vec_id", "label", "embedding")


@query(with_views(CENTRES) + """
SELECT centre_label, vec_id, round(similarity, 6) AS similarity, rank::INT AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY centre_label ORDER BY round(similarity, 9) DESC, vec_id) AS rank FROM cs) WHERE rank <= 5""")
def embedding_topk(spark, d):
    """The five vectors nearest to each class centre."""
    rows = centre_similarity(spark, d).select("vec_id", F.explode("sims").alias("s")).select("vec_id", "s.*")
    w = Window.partitionBy("centre_label").orderBy(F.desc(F.round("similarity", 9)), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where("rank <= 5")


@query("""
WITH q AS (SELECT a.vec_id, b.vec_id AS neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT vec_id, neighbour, round(similarity, 6) AS similarity, rank::INT AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour) AS rank FROM q) WHERE rank <= 5""")
def dense_neighbours(spark, d):
    """The five vectors nearest to every hundredth vector, among all."""
    e = table(spark, d, "embeddings")
    return vi.nearest_vectors(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding", 5)


# Covariance, then the leading eigenvector by repeated squaring (the 2^18th power), again on what is left.
_SQUARE = "list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / t))"
_LEAD = """
p{n}(k, m) AS (SELECT 0, m FROM {source} UNION ALL
  SELECT k + 1, {square} FROM (SELECT k, m, list_sum(list_transform(m, lambda r: list_dot_product(r, r))) AS t FROM p{n}) WHERE k < 18),
v{n} AS (SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS u FROM (SELECT list_reduce(m, lambda a, b:
    CASE WHEN list_dot_product(a, a) >= list_dot_product(b, b) THEN a ELSE b END) AS r FROM p{n} WHERE k = 18)),
e{n} AS (SELECT list_transform(u, lambda x: x * sign(list_reduce(u, lambda a, b: CASE WHEN abs(a) >= abs(b) THEN a ELSE b END))) AS u FROM v{n})"""
PCA_SQL = """
lg AS (SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) r(i)),
mu AS (SELECT i, avg(x) AS a, count(*) AS n FROM lg GROUP BY 1),
ce AS (SELECT vec_id, lg.i, x - a AS x FROM lg JOIN mu USING (i)),
cv AS (SELECT a.i, b.i AS j, sum(a.x * b.x) / ((SELECT max(n) FROM mu) - 1) AS c FROM ce a JOIN ce b USING (vec_id) GROUP BY ALL),
rw AS (SELECT i, list(c ORDER BY j) AS r FROM cv GROUP BY 1),
c1 AS (SELECT list(r ORDER BY i) AS m FROM rw),""" + _LEAD.format(n=1, source="c1", square=_SQUARE) + """,
c2 AS (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * u[i] * u[j])) AS m
  FROM (SELECT m, u, list_dot_product(u, list_transform(m, lambda q: list_dot_product(q, u))) AS l FROM c1, e1)),""" + _LEAD.format(n=2, source="c2", square=_SQUARE)
BOX = PCA_SQL + """,
bx AS (SELECT vec_id, label, list_dot_product(embedding::DOUBLE[], (SELECT u FROM e1)) AS x, list_dot_product(embedding::DOUBLE[], (SELECT u FROM e2)) AS y FROM embeddings),
lm AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM bx),
ub AS (SELECT vec_id, label, round(4e-2 + 92e-2 * (x - xl) / greatest(xh - xl, 1e-9), 4) AS x,
    round(4e-2 + 92e-2 * (y - yl) / greatest(yh - yl, 1e-9), 4) AS y FROM bx, lm)"""


def box(df):
    """The unit box of the map that all dimensions of the embeddings give."""
    return tv.unit_box(ln.flat_map(df, "vec_id", "embedding"), ["x", "y"])


@query(with_recursive(BOX) + "SELECT vec_id, round(x, 6) AS x, round(y, 6) AS y FROM bx")
def map_2d(spark, d):
    """Two principal components of the embeddings."""
    return ln.flat_map(table(spark, d, "embeddings"), "vec_id", "embedding").select("vec_id", "x", "y")


@query(with_recursive(BOX) + "SELECT vec_id, label, x, y FROM ub")
def unit_box(spark, d):
    return box(table(spark, d, "embeddings")).select("vec_id", "label", "x", "y")


PICKED = """
ps AS (SELECT vec_id, arg_max(centre_label, round(similarity, 9) - centre_label * 1e-12) AS p FROM cs GROUP BY 1)"""


def judged_map(spark, d):
    """The map with whether the nearest-centre classifier is right."""
    rows = centre_similarity(spark, d)
    best = F.element_at(F.array_sort(F.transform("sims", lambda s: F.struct(
        F.round(s["similarity"], 9).alias("s"), (-s["centre_label"]).alias("l")))), -1)["l"]
    rows = rows.withColumn("correct", (-best == F.col("label")).cast("int"))
    return box(rows.select("vec_id", "embedding", "correct"))


@query(with_recursive(CENTRES, BOX, PICKED) + """
SELECT least(floor(x * 5), 4)::INT AS cell_x, least(floor(y * 5), 4)::INT AS cell_y, count(*) AS n,
  round(avg(CASE WHEN label = p THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM ub JOIN ps USING (vec_id) GROUP BY ALL""")
def competence_grid(spark, d):
    """Where on the map the nearest-centre classifier is right."""
    return tv.competence_grid(judged_map(spark, d), "x", "y", "correct", 5)


@query(with_recursive(CENTRES, BOX, PICKED, """
jm AS (SELECT x, y, CASE WHEN label = p THEN 1 ELSE 0 END AS ok FROM ub JOIN ps USING (vec_id)),
lt AS (SELECT c AS cell, (c % 24 + 5e-1) / 24e0 AS qx, (c // 24 + 5e-1) / 24e0 AS qy FROM range(576) r(c)),
ds AS (SELECT cell, ok, (qx - x) * (qx - x) + (qy - y) * (qy - y) AS d2 FROM lt, jm),
nn AS (SELECT *, rank() OVER (PARTITION BY cell ORDER BY d2) AS r FROM ds)""") + """
SELECT cell, count(*) AS neighbours, round(avg(ok), 6) AS accuracy, round(sqrt(max(d2)), 6) AS radius FROM nn WHERE r <= 15 GROUP BY cell""")
def competence_surface(spark, d):
    """Share of right answers among the 15 nearest rows at every place of a 24 x 24 lattice over the map."""
    return nb.competence_surface(judged_map(spark, d), "x", "y", "correct", nb.lattice(spark, 24), "cell", 15)


@query()
def lsa_embed(spark, d):
    """Latent semantic vectors of the documents, by length and leading value."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    fit = ln.tfidf_vectors(docs, "doc_id", "text", max_features=3000, n_max=1, tokens=tx.masked_tokens, order="df")
    vectors = fit(docs).select("doc_id", "features")
    emb = ln.latent_space(vectors, "doc_id", "features", 64)
    return emb.select("doc_id", F.size("embedding").alias("k"), F.abs(F.col("embedding")[0]).alias("first"))


def text_model(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("y_true"))
    rows = sp.hash_split(docs, "doc_id", 0.7, "split")
    return rows, ln.TextClassifier(LANGS).fit(rows.where("split = 'train'"), "doc_id")


@query()
def tfidf_logreg(spark, d):
    """Linear text classifier fitted on the train split, scored on the rest."""
    rows, model = text_model(spark, d)
    return cl.per_class(cl.confusion(model.predict(rows.where("split = 'test'"))))


@query(f"""
WITH t AS (SELECT * FROM documents WHERE {u_sql("doc_id", "'split'")} < 0.7e0)
SELECT c AS class, (SELECT count(*) FROM t) AS n, (SELECT count(*) FROM t WHERE lang = c) AS positives, true AS at_optimum
FROM (VALUES ('de'), ('en'), ('es'), ('fr')) k(c)""")
def tfidf_logreg_fit(spark, d):
    """Per class: training rows, and whether the gradient of its loss is 0 up to the tolerance where the fit ended."""
    rows, model = text_model(spark, d)
    fits = spark.createDataFrame([(c, bool(g <= 1e-5)) for c, g in zip(model.classes, model.gradients)], "class string, at_optimum boolean")
    counts = rows.where("split = 'train'").groupBy().agg(F.count("*").alias("n"), *[F.count_if(F.col("y_true") == c).alias(c) for c in LANGS])
    positives = F.element_at(F.create_map(*[x for c in LANGS for x in (F.lit(c), F.col(c))]), F.col("class"))
    return side_by_side(fits, counts).select("class", "n", positives.alias("positives"), "at_optimum")


SHINGLES = """
bt AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM benchmark),
dt AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents),
bs AS (SELECT DISTINCT item_id, unnest([array_to_string(t[i:i + 7], ' ') FOR i IN range(1, len(t) - 6)]) AS s FROM bt),
ds AS (SELECT DISTINCT doc_id, unnest([array_to_string(t[i:i + 7], ' ') FOR i IN range(1, len(t) - 6)]) AS s FROM dt),
bn AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY 1),
hit AS (SELECT doc_id, item_id, count(*) AS matched FROM ds JOIN bs USING (s) GROUP BY ALL),
ct AS (SELECT doc_id, item_id, matched, n_shingles, matched / n_shingles::DOUBLE AS share FROM hit JOIN bn USING (item_id))"""


def leaks(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return lk.contamination(docs, table(spark, d, "benchmark"), "doc_id", "item_id", 8)


@query(with_views(SHINGLES) + "SELECT doc_id, item_id, matched, n_shingles, round(share, 6) AS share FROM ct")
def contamination(spark, d):
    return leaks(spark, d)


@query(with_views(SHINGLES) + "SELECT doc_id, item_id, matched, n_shingles, round(share, 6) AS share FROM ct WHERE share >= 5e-1")
def contamination_by_share(spark, d):
    """Pairs in which the document holds half of the item or more; common shingles pair nothing."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return lk.contaminated_pairs(docs, table(spark, d, "benchmark"), "doc_id", "item_id", 0.5)


@query(with_views(LANG_EVAL, SHINGLES.replace("dt AS", "dtt AS").replace("FROM dt)", "FROM dtt)"), """
sl AS (SELECT v.*, CASE WHEN doc_id IN (SELECT doc_id FROM ct WHERE share >= 5e-1) THEN 'contaminated' ELSE 'clean' END AS slice FROM v_lang_eval v),
cf AS (SELECT slice, y_true, coalesce(y_pred, '∅') AS y_pred, count(*) AS n FROM sl GROUP BY ALL)""", report_sql("cf", "slice")) + """
SELECT slice, n, correct, round(accuracy, 6) AS accuracy, round(macro_precision, 6) AS macro_precision,
  round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1 FROM
  (SELECT slice, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (y_true = y_pred), 0)::BIGINT AS correct,
    coalesce(sum(n) FILTER (y_true = y_pred), 0) / sum(n) AS accuracy FROM cf GROUP BY 1)
  JOIN (SELECT slice, coalesce(avg(p), 0) AS macro_precision, coalesce(avg(r), 0) AS macro_recall, avg(f) AS macro_f1 FROM report GROUP BY 1) USING (slice)""")
def clean_vs_contaminated(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    hits = lk.contaminated_pairs(docs, table(spark, d, "benchmark"), "doc_id", "item_id", 0.5)
    rows = lk.flag_contaminated(lang_eval(spark, d), hits, "doc_id")
    return cl.summary(cl.confusion(rows, by=["slice"]), by=["slice"])

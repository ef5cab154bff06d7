"""Shared evaluation views over the given tables, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.functions.frames import pinned
from gaugeline.functions.scores import half_step_score
from gaugeline.functions.text import word_tokens
from gaugeline.operators.judging import reply_pairs
from gaugeline.sources.tables import table

# Function words that give a language away.
LANG_WORDS = {
    "de": ["der", "die", "und", "für", "nicht", "sch"],
    "en": ["the", "of", "and", "to", "for", "with"],
    "es": ["el", "los", "que", "por", "una", "ción"],
    "fr": ["le", "la", "que", "les", "une", "et"],
}
LANGS = list(LANG_WORDS)


def lang_eval(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return lang_eval_frame(docs)


def lang_eval_frame(docs: DataFrame) -> DataFrame:
    """doc_id, y_true (language), y_pred (by function words, may be NULL), conf.

    Tokens are cut to function words first; the per-language counts then run
    over that short list.
    """
    known = sorted({w for ws in LANG_WORDS.values() for w in ws})
    toks = docs.select("doc_id", F.col("lang").alias("y_true"), "source", word_tokens(F.col("text")).alias("t"))
    hits = toks.withColumn("t", F.filter("t", lambda w: w.isin(known)))
    n = {c: F.col(f"n_{c}") for c in LANGS}
    hits = pinned(hits, {f"n_{c}": F.size(F.filter("t", _member(LANG_WORDS[c]))) for c in LANGS})
    best, total = F.greatest(*n.values()), sum(n.values(), F.lit(0))
    pred = None
    for c in LANGS:
        hit = (n[c] == best) & (best > 0)
        pred = F.when(hit, c) if pred is None else pred.when(hit, c)
    return hits.select("doc_id", "y_true", "source", pred.alias("y_pred"),
                       (best / F.nullif(total, F.lit(0))).alias("conf"))


def _member(words):
    return lambda w: w.isin(words)


def quality_eval(spark, folder) -> DataFrame:
    """doc_id, y_true (quality), toxic, lang, source, n_chars, pred_A, pred_B."""
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y_true"), "toxic", "lang", "source", "n_chars",
        (F.col("n_chars") >= 400).cast("int").alias("pred_A"), F.lit(1).alias("pred_B"))


def scores(spark, folder) -> DataFrame:
    """event_id, user_id, ts, day, system A/B, metric, score in half steps."""
    e = table(spark, folder, "events")
    return e.select(
        "event_id", "user_id", "ts", F.col("ts").cast("date").alias("day"),
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("system"),
        F.col("event_type").alias("metric"), half_step_score(F.col("value")).alias("score"))


def pairs(spark, folder) -> DataFrame:
    return reply_pairs(table(spark, folder, "conversations"))


def _sql_words(c):
    return "[" + ", ".join(f"'{w}'" for w in LANG_WORDS[c]) + "]"


_COUNTS = ", ".join(
    f"len(list_filter(t, lambda x: list_contains({_sql_words(c)}, x))) AS n_{c}" for c in LANGS)
_BEST = "greatest(n_de, n_en, n_es, n_fr)"

LANG_EVAL = rf"""
lang_tok AS (SELECT doc_id, lang AS y_true, source,
    regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM documents),
lang_cnt AS (SELECT doc_id, y_true, source, {_COUNTS} FROM lang_tok),
v_lang_eval AS (SELECT doc_id, y_true, source,
    CASE WHEN {_BEST} = 0 THEN NULL WHEN n_de = {_BEST} THEN 'de' WHEN n_en = {_BEST} THEN 'en'
         WHEN n_es = {_BEST} THEN 'es' ELSE 'fr' END AS y_pred,
    {_BEST} / nullif(n_de + n_en + n_es + n_fr, 0)::DOUBLE AS conf FROM lang_cnt)"""

QUALITY_EVAL = """
v_quality_eval AS (SELECT l.doc_id, l.quality AS y_true, l.toxic, d.lang, d.source, d.n_chars,
    CASE WHEN d.n_chars >= 400 THEN 1 ELSE 0 END AS pred_A, 1 AS pred_B
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

SCORES = """
v_scores AS (SELECT event_id, user_id, ts, ts::DATE AS day,
    CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS system, event_type AS metric,
    least(5e0, 1e0 + floor(value / 50e0 * 2e0 + 5e-1) / 2e0) AS score FROM events)"""

PAIRS = """
v_pairs AS (SELECT a.conv_id, a.turn, a.text AS reply, u.text AS reference
  FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE a.role = 'assistant' AND u.role = 'user')"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)


def with_recursive(*views: str) -> str:
    return "WITH RECURSIVE " + ",".join(views)

"""Sources, sinks, cleaning and validation on the given tables."""

from pyspark.sql import functions as F

from gaugeline.functions import text as tx
from gaugeline.functions.frames import lookup, pinned
from gaugeline.functions.hashing import uniform
from gaugeline.operators import ingest as ing, reporting as rp, sampling as sp
from gaugeline.operators.judging import parse_reply
from gaugeline.plans.comparisons import CARDS, cards
from gaugeline.plans.registry import query
from gaugeline.plans.views import quality_eval, with_views
from gaugeline.sources import tables as src
from gaugeline.sources.tables import table


@query("SELECT conv_id, turn, role, md5(text) AS digest FROM conversations")
def csv_scan(spark, d):
    """Turns with line breaks and quotes written as CSV and scanned back."""
    turns = table(spark, d, "conversations")
    path = src.write(turns, src.scratch(spark, "csv"), "csv")
    return src.read_csv(spark, path, turns.schema, multiline=True).select("conv_id", "turn", "role", F.md5("text").alias("digest"))


@query("SELECT doc_id, lang AS dataset, quality, toxic FROM labels JOIN documents USING (doc_id)")
def json_bundle_scan(spark, d):
    """One nested JSON object per source with its items, flattened on read."""
    rows = quality_eval(spark, d).withColumn("part", F.floor(F.col("doc_id") / 1000))
    item = F.struct("doc_id", F.col("y_true").alias("quality"), "toxic")
    nested = rows.groupBy(F.col("lang").alias("dataset"), "part").agg(F.collect_list(item).alias("items"))
    path = src.write(nested.drop("part"), src.scratch(spark, "json"), "json")
    schema = "dataset string, items array<struct<doc_id: bigint, quality: int, toxic: int>>"
    raw = spark.read.schema(schema).json(path)
    return raw.select("dataset", F.explode("items").alias("i")).select("dataset", "i.*")


@query("SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 50")
def jsonl_top(spark, d):
    """JSON Lines scan, sorted by id, first rows."""
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    path = src.write(events, src.scratch(spark, "jsonl"), "json")
    return src.read_jsonl(spark, path, events.schema, "event_id", 50)


@query("SELECT doc_id, n_chars FROM documents")
def ledger_resume(spark, d):
    """Outputs written in two runs; the second run adds only what is missing."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    path = src.scratch(spark, "ledger")
    src.append_pending(spark, docs.where(uniform(F.col("doc_id"), "first") < 0.5), path, "doc_id", lambda x: x)
    return src.append_pending(spark, docs, path, "doc_id", lambda x: x)


@query("SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def cache_if_absent(spark, d):
    """A table that is there already is read, not made again: the second frame never replaces the first."""
    path = src.scratch(spark, "cache")
    src.write_if_absent(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")), path)
    src.write_if_absent(table(spark, d, "documents").limit(1).select("lang", F.lit(0).cast("long").alias("n")), path)
    return spark.read.parquet(path)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, d):
    return src.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("""
SELECT 'quality' AS dataset, doc_id, quality::VARCHAR AS y_true, NULL::BIGINT AS n_chars FROM labels
UNION ALL SELECT 'language', doc_id, lang, n_chars FROM documents""")
def bundle_union(spark, d):
    q = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("y_true"))
    lang = table(spark, d, "documents").select("doc_id", F.col("lang").alias("y_true"), "n_chars")
    return src.bundle({"quality": q, "language": lang})


@query("""
WITH p AS (SELECT CASE WHEN p_partkey % 5 = 4 THEN 'missing' WHEN p_partkey % 5 = 0 THEN 'list' WHEN p_partkey % 5 = 1 THEN 'delimited' ELSE 'scalar' END AS shape,
  CASE p_partkey % 5 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN split_part(p_name, ' ', 1) WHEN 2 THEN p_name WHEN 3 THEN '[' || p_name ELSE '∅' END AS class,
  CASE p_partkey % 5 WHEN 4 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE len(string_split(p_name, ' ')) END AS n_labels FROM part)
SELECT shape, class, n_labels::INT AS n_labels, count(*) AS n FROM p GROUP BY ALL""")
def labels_normalise(spark, d):
    """Label columns as list text, ;-list, scalar, broken list and NULL, made from part names."""
    name, kind = F.col("p_name"), F.col("p_partkey") % 5
    raw = (F.when(kind == 0, F.concat(F.lit("['"), F.replace(name, F.lit(" "), F.lit("', '")), F.lit("']")))
           .when(kind == 1, F.concat(F.replace(name, F.lit(" "), F.lit(" ;")), F.lit("; ")))
           .when(kind == 2, F.concat(F.lit("  "), name, F.lit("\n")))
           .when(kind == 3, F.concat(F.lit("["), name)))
    rows = table(spark, d, "part").select(raw.alias("raw"))
    rows = rows.select(ing.labels_shape(F.col("raw")).alias("shape"), ing.parse_labels(F.col("raw")).alias("labels"))
    return rows.groupBy("shape", ing.single_class(F.col("labels")).alias("class"), F.size("labels").alias("n_labels")).agg(
        F.count("*").alias("n"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def category_filter(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query(r"""SELECT doc_id, words::INT AS words FROM (SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS words FROM documents WHERE text IS NOT NULL)
           WHERE words BETWEEN 50 AND 2000""")
def doc_word_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text").where("text IS NOT NULL")
    counted = pinned(docs, {"words": tx.word_count(F.col("text"))})
    return counted.where("words BETWEEN 50 AND 2000").select("doc_id", "words")


@query("SELECT doc_id, CASE quality WHEN 0 THEN 'NEGATIVE' WHEN 1 THEN 'POSITIVE' END AS label FROM labels")
def label_names(spark, d):
    return table(spark, d, "labels").select("doc_id", lookup({0: "NEGATIVE", 1: "POSITIVE"}, F.col("quality")).alias("label"))


@query("""SELECT event_id, coalesce(nullif(props->>'$.key', ''), nullif(props->>'$.k', ''))::INT AS k FROM events""")
def props_extract(spark, d):
    return table(spark, d, "events").select("event_id", ing.json_field(F.col("props"), "key", "k").cast("int").alias("k"))


@query(r"""SELECT conv_id, md5(string_agg(text, E'\n\n---\n\n' ORDER BY turn)) AS digest, count(*)::INT AS n_parts FROM conversations GROUP BY 1""")
def conversation_concat(spark, d):
    out = ing.concat_parts(table(spark, d, "conversations"), "conv_id", "turn", "text", "\n\n---\n\n")
    return out.select("conv_id", F.md5("text").alias("digest"), "n_parts")


@query(r"""SELECT doc_id, array_to_string(regexp_extract_all(text, '\S+')[1:120], ' ') AS excerpt FROM documents""")
def doc_excerpt(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", tx.excerpt(F.col("text"), 120).alias("excerpt"))


ANSWER_CLASSES = ["de", "en", "es", "fr"]


@query("""
WITH n AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
k AS (SELECT *, i // 20 AS batch, max(i) OVER (PARTITION BY i // 20) AS last FROM n)
SELECT batch, doc_id AS item_id, CASE WHEN batch % 4 = 3 OR doc_id % 7 = 0
  OR (batch % 4 = 2 AND i = last) THEN NULL ELSE lang END AS y_pred FROM k""")
def batch_answers_ingest(spark, d):
    """Raw answers to batches of 20: plain, fenced, in prose with one missing, or no array."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    rows = sp.batches(docs, "doc_id", 20)
    said = F.when(F.col("doc_id") % 7 == 0, F.lit('"klingon"')).when(
        F.col("doc_id") % 13 == 0, F.concat(F.lit('["'), "lang", F.lit('"]'))).otherwise(
        F.concat(F.lit('"'), "lang", F.lit('"')))
    packed = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("doc_id", said.alias("a")))).alias("x"))
    kind = F.col("batch") % 4
    answers = F.when(kind == 2, F.slice("x.a", 1, F.size("x") - 1)).otherwise(F.col("x.a"))
    body = F.concat(F.lit("["), F.array_join(answers, ", "), F.lit("]"))
    raw = (F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
           .when(kind == 2, F.concat(F.lit("Sure, here it is:\n"), body, F.lit(" Anything else?")))
           .otherwise(F.lit("I cannot answer that.")))
    asked = packed.select("batch", F.col("x.doc_id").alias("items"), raw.alias("raw"))
    return ing.align_batch(asked, ["batch"], "items", "raw", ANSWER_CLASSES)


@query("""
WITH r AS (SELECT event_type AS judge, CASE event_id % 6 WHEN 0 THEN 1 + event_id % 5 WHEN 1 THEN 35e-1 WHEN 5 THEN 5 END::DOUBLE AS score FROM events)
SELECT judge, count(*) AS n, count(*) - count(score) AS rejected, round((count(*) - count(score)) / count(*), 6) AS reject_rate,
  round(avg(score), 6) AS mean_score FROM r GROUP BY 1""")
def judge_reply_ingest(spark, d):
    """Raw judge replies: number, sentence, out of range, no number, empty, two lines."""
    kind, id_ = F.col("event_id") % 6, F.col("event_id")
    raw = (F.when(kind == 0, (1 + id_ % 5).cast("string")).when(kind == 1, "Score: 3.5.")
           .when(kind == 2, "7 out of 5").when(kind == 3, "no idea").when(kind == 4, "")
           .otherwise(F.lit(" 5\nbecause it is right, 2 reasons")))
    rows = table(spark, d, "events").select(F.col("event_type").alias("judge"), parse_reply(raw, "scale_1_5").alias("score"))
    return ing.reject_rate(rows, ["judge"], "score", F.avg("score").alias("mean_score"))


@query(with_views(CARDS, """
k AS (SELECT *, ((l_orderkey + l_linenumber) % 5)::INT AS kind FROM v_cards)""") + """
SELECT kind, count(*) AS n, count(*) FILTER (kind >= 2) AS rejected, round(count(*) FILTER (kind >= 2) / count(*), 6) AS reject_rate,
  round(avg(least(5e0, greatest(1e0, round_even((45e-2 * accuracy + 45e-2 * completeness + 1e-1 * fluency) * 2, 0) / 2)))
    FILTER (kind < 2), 6) AS mean_overall, count(*) FILTER (kind = 1) AS explained FROM k GROUP BY 1""")
def scorecard_ingest(spark, d):
    """Scorecard JSON: plain, in prose, a dimension missing, a number as text, out of range."""
    kind = ((F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int")

    def field(name, value):
        return F.concat(F.lit(f'"{name}": '), value.cast("string"))

    acc, com, flu = (field(c, F.col(c)) for c in ("accuracy", "completeness", "fluency"))
    two = F.concat_ws(", ", acc, com)
    raw = (F.when(kind == 0, F.concat(F.lit("{"), two, F.lit(", "), flu, F.lit("}")))
           .when(kind == 1, F.concat(F.lit("My verdict:\n{"), two, F.lit(", "), flu, F.lit(', "rationale": "clear"}\nDone.')))
           .when(kind == 2, F.concat(F.lit("{"), two, F.lit("}")))
           .when(kind == 3, F.concat(F.lit('{"accuracy": "4", '), com, F.lit(", "), flu, F.lit("}")))
           .otherwise(F.concat(F.lit('{"accuracy": 9, '), com, F.lit(", "), flu, F.lit("}"))))
    rows = ing.parse_scorecards(cards(spark, d).select(kind.alias("kind"), raw.alias("raw")), "raw", "card")
    parts = {c: F.col(f"card.{c}") for c in rp.SCORECARD_WEIGHTS}
    rows = rows.withColumn("overall", rp.overall(parts))
    return rows.groupBy("kind").agg(
        F.count("*").alias("n"), F.count_if(F.col("card").isNull()).alias("rejected"),
        F.avg(F.col("card").isNull().cast("double")).alias("reject_rate"), F.avg("overall").alias("mean_overall"),
        F.count_if(F.col("card.rationale") == "clear").alias("explained"))


PHRASES = ["is the", "que la", "nicht die"]


@query(r"""
WITH c AS (SELECT count(*) AS n, count(*) FILTER (text IS NULL OR trim(text) = '') AS empty_text, count(*) FILTER (length(text) > 1000) AS too_long,
    count(*) FILTER (regexp_matches(lower(text), '(^|[^a-z0-9])(is the|que la|nicht die)($|[^a-z0-9])')) AS forbidden_phrase,
    count(*) FILTER (conv_id IS NULL) AS missing_id FROM conversations),
e AS (SELECT count(*) AS n, count(*) FILTER (NOT json_valid(props)) AS bad_json, count(*) FILTER (props->>'$.k' IS NULL) AS k_missing,
    count(*) FILTER ((props->>'$.k')::INT > 90) AS k_out_of_range FROM events)
SELECT rule, n, failed FROM (SELECT n, empty_text, too_long, forbidden_phrase, missing_id FROM c)
  UNPIVOT (failed FOR rule IN (empty_text, too_long, forbidden_phrase, missing_id))
UNION ALL SELECT rule, n, failed FROM (SELECT n, bad_json, k_missing, k_out_of_range FROM e)
  UNPIVOT (failed FOR rule IN (bad_json, k_missing, k_out_of_range))""")
def hard_checks(spark, d):
    t, parsed = F.col("text"), F.from_json("props", F.lit("map<string,string>"))
    k = F.try_element_at(parsed, F.lit("k"))
    turns = ing.hard_checks(table(spark, d, "conversations"), {
        "empty_text": t.isNull() | (F.trim(t) == ""), "too_long": F.char_length(t) > 1000,
        "forbidden_phrase": ing.contains_phrase(t, PHRASES), "missing_id": F.col("conv_id").isNull()})
    events = ing.hard_checks(table(spark, d, "events"), {
        "bad_json": parsed.isNull(), "k_missing": k.isNull(), "k_out_of_range": k.cast("int") > 90})
    return turns.unionByName(events)


@query("""
WITH h AS (SELECT l_linestatus, l_discount * 10 AS a, l_tax * 15 AS b FROM lineitem),
s AS (SELECT l_linestatus, CASE WHEN a BETWEEN 0 AND 1 AND b BETWEEN 0 AND 1 THEN sqrt(a * a + b * b) END AS s FROM h)
SELECT l_linestatus, count(*) AS n, count(*) FILTER (s IS NULL) AS quarantined, count(*) FILTER (s >= 8e-1 + 1e-9) AS alerts,
  round(avg(s), 6) AS mean_score, round(max(s), 6) AS max_score FROM s GROUP BY 1""")
def host_health_scan(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_linestatus", ing.host_score(F.col("l_discount") * 10, F.col("l_tax") * 15).alias("s"))
    return rows.groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.count_if(F.col("s").isNull()).alias("quarantined"),
        F.count_if(F.col("s") >= 0.8 + 1e-9).alias("alerts"), F.avg("s").alias("mean_score"), F.max("s").alias("max_score"))


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, max(sqrt(l_discount * 10 * (l_discount * 10) + l_tax * 10 * (l_tax * 10))) AS a,
    max(greatest(l_discount, l_tax) * 10 * sqrt(1 + pow(least(l_discount, l_tax) / nullif(greatest(l_discount, l_tax), 0), 2))) AS m FROM lineitem GROUP BY ALL),
d AS (SELECT a, coalesce(m, 0) AS b FROM k)
SELECT count(*) AS keys, count(*) FILTER (abs(a - b) <= greatest(1e-9 * greatest(abs(a), abs(b)), 1e-12)) AS close,
  count(*) FILTER ((a IS NULL) <> (b IS NULL)) AS one_sided FROM d""")
def golden_diff(spark, d):
    """Two ways to compute the same score, compared by key with a tolerance."""
    a, b = F.col("l_discount") * 10, F.col("l_tax") * 10
    key = ["l_orderkey", "l_linenumber"]
    li = table(spark, d, "lineitem")
    old, new = (li.groupBy(*key).agg(F.max(v).alias("v")) for v in (F.sqrt(a * a + b * b), F.hypot(a, b)))
    diff = ing.golden_diff(old, new, key, "v")
    return diff.agg(F.count("*").alias("keys"), F.count_if("close").alias("close"), F.count_if("one_sided").alias("one_sided"))


@query("SELECT d.doc_id, quality AS prediction, l.doc_id IS NULL AS missing FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def attach_cached_predictions(spark, d):
    stored = table(spark, d, "labels").withColumnRenamed("quality", "prediction")
    return ing.attach(table(spark, d, "documents").select("doc_id"), stored, "doc_id", "prediction")


@query("""
SELECT count(*) FILTER (l.doc_id IS NULL) AS left_only, count(*) FILTER (d.doc_id IS NULL) AS right_only,
  count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL AND (d.n_chars >= 400)::INT <> l.quality) AS value_differs,
  count(*) AS keys FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def alignment_check(spark, d):
    docs = table(spark, d, "documents").select("doc_id", (F.col("n_chars") >= 400).cast("int").alias("v"))
    labels = table(spark, d, "labels").withColumnRenamed("quality", "v")
    return ing.alignment(docs, labels, "doc_id", "v")


@query("""
WITH a AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, (n_chars >= 400)::INT AS x FROM documents),
b AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, quality AS y FROM labels)
SELECT count(*) FILTER (b.position IS NULL) AS left_only, count(*) FILTER (a.position IS NULL) AS right_only, count(*) FILTER (x <> y) AS value_differs,
  min(coalesce(a.position, b.position)) FILTER (x <> y) AS first_difference, count(*) AS positions FROM a FULL JOIN b ON a.position = b.position""")
def alignment_by_position(spark, d):
    """Guessed and labelled quality line by line, as two lists are compared that carry no key."""
    docs = table(spark, d, "documents").select("doc_id", (F.col("n_chars") >= 400).cast("int").alias("v"))
    labels = table(spark, d, "labels").withColumnRenamed("quality", "v")
    return ing.alignment_by_position(docs, labels, ["doc_id"], ["doc_id"], "v")


TAGS = """
tg AS (SELECT p_partkey, list_distinct(string_split(p_name || ' ' || lower(p_type) || ' size' || (p_size // 10), ' ')) AS t FROM part),
ex AS (SELECT p_partkey, unnest(t) AS tag FROM tg)"""


@query(with_views(TAGS) + """
SELECT 'tag' AS kind, tag AS tag_1, NULL AS tag_2, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 6) AS share FROM ex GROUP BY tag
UNION ALL SELECT 'tags_per_item', len(t)::VARCHAR, NULL, count(*), NULL FROM tg GROUP BY len(t)
UNION ALL SELECT 'pair', a.tag, b.tag, count(*), NULL FROM ex a JOIN ex b ON a.p_partkey = b.p_partkey AND a.tag < b.tag GROUP BY a.tag, b.tag""")
def multilabel_profile(spark, d):
    tags = F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), F.concat(F.lit("size"), F.floor(F.col("p_size") / 10))), " ")
    prevalence, sizes, pairs = ing.tag_profile(table(spark, d, "part").select(tags.alias("tags")), "tags")
    null = F.lit(None)
    return (
        prevalence.select(F.lit("tag").alias("kind"), F.col("tag").alias("tag_1"), null.cast("string").alias("tag_2"), "n", "share")
        .unionByName(sizes.select(F.lit("tags_per_item").alias("kind"), F.col("n_tags").cast("string").alias("tag_1"),
                                  null.cast("string").alias("tag_2"), "n", null.cast("double").alias("share")))
        .unionByName(pairs.select(F.lit("pair").alias("kind"), "tag_1", "tag_2", "n", null.cast("double").alias("share"))))

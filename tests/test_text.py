import math
import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import text as tx
from gaugeline.operators import judging as jd, leakage as lk, textvec as tv


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize("raw, expected", [
    ("  Paris. ", "paris"), ("Paris .", "paris "), ("A\n\tB  c!?", "a b c"), ("...", ""), ("", ""), ("a,b;", "a,b"),
])
def test_normalise(spark, raw, expected):
    assert one(spark, tx.normalise(F.col("t")), t=raw) == expected


def test_tokens(spark):
    assert one(spark, tx.judge_tokens(F.col("t")), t="Été 2x A_b") == ["t", "2x", "a", "b"]
    assert one(spark, tx.word_tokens(F.col("t")), t="Été 2x A_b c") == ["été", "2x", "a_b"]
    assert one(spark, tx.masked_tokens(F.col("t")), t="Hi {{Order Number}} now") == ["hi", "now"]


@pytest.mark.parametrize("raw, n", [("", 0), ("   ", 0), (" a  b\nc ", 3)])
def test_word_count(spark, raw, n):
    assert one(spark, tx.word_count(F.col("t")), t=raw) == n


def test_excerpt(spark):
    assert one(spark, tx.excerpt(F.col("t"), 3), t=" a  b\nc d e") == "a b c"
    assert one(spark, tx.excerpt(F.col("t"), 9), t="a b") == "a b"


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r.g for r in df.select(tx.ngrams_upto(F.col("t"), 2).alias("g")).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def f1(a, b):
    a, b = (re.findall("[a-z0-9]+", s.lower()) for s in (a, b))
    ca, cb = collections.Counter(a), collections.Counter(b)
    o = sum((ca & cb).values())
    return 0.0 if o == 0 else 2 * (o / len(a)) * (o / len(b)) / (o / len(a) + o / len(b))


def test_token_overlap_against_brute_force(spark):
    rnd = random.Random(1)
    words = ["the", "The", "fix", "fix", "reset", "vpn", "ok!", "...", ""]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 8))), " ".join(rnd.choices(words, k=rnd.randint(0, 8))))
            for i in range(60)] + [(60, "", "a"), (61, "...", "..."), (62, "a b", "a b")]
    df = spark.createDataFrame(rows, "id int, reply string, reference string")
    got = {r.id: r.token_f1 for r in jd.token_overlap(df, ["id"]).collect()}
    assert got == pytest.approx({i: f1(a, b) for i, a, b in rows})


@pytest.mark.parametrize("answer, reference, strict, lenient, scale", [
    ("Paris", "Paris", 1, 1, 5), ("It's Paris, the City of Light.", "Paris", 0, 1, 4), ("Marseille", "Paris", 0, 0, 2),
    ("big city", "the city", 0, 0, 3), ("42", "Paris", 0, 0, 1),
])
def test_qa_judges(spark, answer, reference, strict, lenient, scale):
    cols = jd.qa_scores(F.col("a"), F.col("r"))
    df = spark.createDataFrame([(answer, reference)], "a string, r string")
    row = df.select(*[c.alias(n) for n, c in cols.items()]).first()
    assert (row.strict, row.lenient, row.scale_1_5) == (strict, lenient, scale)


def test_registry_checks_the_kind(spark):
    reg = jd.JudgeRegistry().register("len", "scale_1_5", lambda a, r: F.char_length(a))
    df = spark.createDataFrame([(1, "abc", ""), (2, "abcdefgh", "")], "id int, reply string, reference string")
    rows = reg.run(df, ["id"], n_reruns=2).collect()
    assert sorted((r.id, r.rerun, r.score) for r in rows if r.id == 1) == [(1, 0, 3.0), (1, 1, 3.0)]
    assert all(r.score is None for r in rows if r.id == 2)
    with pytest.raises(ValueError):
        reg.register("x", "stars", lambda a, r: a)


def sparse_rows(rng, n, vocab, prefix):
    rows = []
    for i in range(n):
        terms = {"the", "of"} if i % 3 else {"the"}  # terms that nearly every text has
        terms |= set(rng.choice(vocab, size=rng.integers(1, 6), replace=False))
        w = {t: float(rng.random() * (0.2 if t in ("the", "of") else 1.0) + 0.01) for t in terms}
        norm = sum(v * v for v in w.values()) ** 0.5
        rows += [(f"{prefix}{i:03d}", t, v / norm) for t, v in w.items()]
    return rows


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_example_is_exact(spark, k):
    rng = np.random.default_rng(k)
    vocab = [f"w{i}" for i in range(30)]
    q, e = sparse_rows(rng, 40, vocab, "q"), sparse_rows(rng, 50, vocab, "e")
    qd, ed = spark.createDataFrame(q, "q string, term string, weight double"), spark.createDataFrame(e, "e string, term string, weight double")
    got = {(r.q, r["rank"]): (r.e, round(r.similarity, 9)) for r in tv.nearest_example(qd, ed, "q", "e", k).collect()}
    vec = lambda rows: {key: {t: w for kk, t, w in rows if kk == key} for key in {r[0] for r in rows}}
    qv, evs = vec(q), vec(e)
    want = {}
    for name, v in qv.items():
        sims = sorted(((-round(sum(w * x.get(t, 0) for t, w in v.items()), 9), en) for en, x in evs.items()))
        for i, (s, en) in enumerate([x for x in sims if -x[0] > 1e-9][:k]):
            want[(name, i + 1)] = (en, -s)
    assert got == want
    # the common terms are skipped for most queries
    _, seek = tv.candidates(qd, ed, "q", "e", k)
    assert seek.where("term = 'the'").count() < qd.where("term = 'the'").count() / 2


def test_nearest_example_of_one_word_and_of_a_word_in_all_examples(spark):
    e = [(f"e{i:02d}", t, w) for i in range(30) for t, w in (("all", 0.1 + i / 100), (f"own{i}", 0.9))]
    q = [("one", "all", 1.0), ("both", "all", 0.6), ("both", "own3", 0.8), ("none", "zzz", 1.0)]
    qd, ed = spark.createDataFrame(q, "q string, term string, weight double"), spark.createDataFrame(e, "e string, term string, weight double")
    got = {(r.q, r["rank"]): r.e for r in tv.nearest_example(qd, ed, "q", "e", 2).collect()}
    assert got == {("one", 1): "e29", ("one", 2): "e28", ("both", 1): "e03", ("both", 2): "e29"}


def test_terms_are_counted_without_moving_text(spark):
    docs = spark.createDataFrame([(1, "b a b {{x y}} B"), (2, ""), (3, None), (4, "a")], "id int, body string")
    counts = tv.term_counts(docs, "id", "body")
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 1), (1, "b", 3), (4, "a", 1)]
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    two = tv.term_counts(docs, "id", "body", tx.masked_tokens, 2).where("id = 1").collect()
    assert sorted((r.term, r.tf) for r in two) == [("a", 1), ("a b", 1), ("b", 3), ("b a", 1), ("b b", 1)]


def test_exported_weights(spark, folder):
    import json

    with open(f"{folder}/model.json", "w") as f:
        json.dump({"classes": ["x", "y"], "ngram_max": 1, "vocab": {"b": 0, "a": 1}, "idf": [2.0, 1.0], "coef": [[1.0, 0.0], [0.0, 3.0]], "intercept": [0.5, 0.0]}, f, indent=1)
    model, intercepts, classes = tv.read_linear_model(spark, f"{folder}/model.json")
    docs = spark.createDataFrame([(1, "b b c"), (2, "a"), (3, "")], "id int, body string")
    counts = tv.term_counts(docs, "id", "body")
    weights = tv.normalised(tv.raw_weights(counts, model, "id"), "id")
    got = {r.id: (round(r.score_x, 6), round(r.score_y, 6), r.y_pred) for r in tv.linear_scores(weights, model.drop("idf"), intercepts, "id", classes, docs).collect()}
    assert got == {1: (1.5, 0.0, "x"), 2: (0.5, 3.0, "y"), 3: (0.5, 0.0, "x")}


def test_nearest_example_none(spark):
    q = spark.createDataFrame([("q", "x", 1.0)], "q string, term string, weight double")
    e = spark.createDataFrame([("e", "y", 1.0)], "e string, term string, weight double")
    assert tv.nearest_example(q, e, "q", "e").count() == 0


def test_contamination_counts_whole_texts(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"x{i}" for i in range(5000)) + " " + passage
    docs = spark.createDataFrame([(1, long), (2, "nothing here at all"), (3, " ".join(passage.split()[:12]))], "doc int, text string")
    tests = spark.createDataFrame([(7, passage), (8, "too short")], "item int, text string")
    got = {(r.doc, r.item): r.share for r in lk.contamination(docs, tests, "doc", "item", 8).collect()}
    assert got == {(1, 7): 1.0, (3, 7): pytest.approx(5 / 13)}


def test_unit_box(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (5.0, 5.0)], "x double, y double")
    rows = [(r.x, r.y) for r in tv.unit_box(df, ["x", "y"]).collect()]
    assert rows == [(0.04, 0.04), (0.96, 0.04), (0.5, 0.04)]


def test_contaminated_pairs_equal_the_filtered_full_result(spark):
    boiler = " ".join(f"b{i}" for i in range(30))
    own = [" ".join(f"i{j}x{i}" for i in range(25)) for j in range(6)]
    items = spark.createDataFrame([(j, f"{boiler} {own[j]}") for j in range(6)], "item int, text string")
    texts = [f"{boiler} {own[0]}", boiler, own[1], f"{own[2]} {boiler[:40]}", "clean text", f"{own[3]} {own[4]} {boiler}",
             " ".join((boiler + " " + own[5]).split()[:40])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    full = lk.contamination(docs, items, "doc", "item", 8)
    for cut in (0.3, 0.5, 0.9, 1.0):
        want = {(r.doc, r.item, r.matched) for r in full.where(f"share >= {cut}").collect()}
        got = {(r.doc, r.item, r.matched) for r in lk.contaminated_pairs(docs, items, "doc", "item", cut).collect()}
        assert got == want, cut


def test_a_judge_may_be_a_pandas_udf(spark):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def longer(a, r):
        return (a.str.len() > r.str.len()).astype("float64")

    reg = jd.JudgeRegistry().register("longer", "binary", longer)
    df = spark.createDataFrame([(1, "abc", "a"), (2, "a", "abc")], "id int, reply string, reference string")
    assert {r.id: r.score for r in reg.run(df, ["id"]).collect()} == {1: 1.0, 2: 0.0}


def test_counts_move_once_to_their_terms_and_once_to_their_items(spark):
    """Rows of one key share labels, rows without a key count for the idf alone; the plan holds no window and no second move of the counts."""
    texts = [(1, "a b b", "x"), (1, "a c", "y"), (2, "b c c", "y"), (3, "", "x"), (None, "a d", "x"), (None, "d", None), (4, "a b", "x")]
    docs = spark.createDataFrame(texts, "id int, body string, lab string")
    counts = tv.term_counts(docs, "id", "body", keep=["lab"])
    model, intercepts = tv.log_odds_model(counts, docs, "id", "lab", ["x", "y"])
    got = {r.term: r for r in model.collect()}
    assert sorted(got) == ["a", "b", "c"]  # d has no row with a key
    n, df, in_x = 7, {"a": 4, "b": 3, "c": 2}, {"a": (5, 3), "b": (4, 2), "c": (3, 1)}
    for t, r in got.items():
        every, x = in_x[t]
        assert r.idf == pytest.approx(math.log((1 + n) / (1 + df[t])) + 1)
        assert r.coef_x == pytest.approx(math.log((x + 1) / (4 + 2)) - math.log((every - x + 1) / (n - 4 + 2)))
    scored = tv.linear_scores_of_counts(counts, model, intercepts, "id", ["x", "y"], docs.select("id", "lab"))
    idf = model.select("term", "idf")
    plain = tv.linear_scores(tv.normalised(tv.raw_weights(counts, idf, "id"), "id"), model.drop("idf"), intercepts, "id", ["x", "y"], docs.select("id", "lab"))
    rows = lambda f: sorted(((r.id, r.lab, round(r.score_x, 9), round(r.score_y, 9), r.y_pred) for r in f.collect()), key=str)
    assert rows(scored) == rows(plain) and len(rows(scored)) == 7
    assert "Window" not in scored._jdf.queryExecution().toString()

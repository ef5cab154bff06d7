"""Fitted models against numpy: the semantic space, the classifier's optimum, the map."""

import glob
import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gaugeline.functions import text as tx
from gaugeline.operators import learned as ln
from gaugeline.operators import textvec as tv
from gaugeline.sources import tables

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "cats and dogs", "a quick brown fox", "the quick dog", "brown cat brown dog", "", "zebra"]


def tfidf(texts, tokens, size, order):
    counts = [Counter(tokens(t)) for t in texts]
    df, total = Counter(w for c in counts for w in c), sum(counts, Counter())
    rank = {"df": df, "total": total}[order]
    vocab = sorted((w for w in df if df[w] >= 2), key=lambda w: (-rank[w], w))[:size]
    out = np.zeros((len(texts), len(vocab)))
    for i, c in enumerate(counts):
        for j, w in enumerate(vocab):
            out[i, j] = c[w] * (math.log((1 + len(texts)) / (1 + df[w])) + 1)
        n = np.linalg.norm(out[i])
        out[i] /= n or 1
    return out


@pytest.mark.parametrize("order,size", [("df", 3), ("total", 3), ("df", 50)])
def test_tfidf_vectors(spark, order, size):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string")
    fit = ln.tfidf_vectors(docs, "id", "body", max_features=size, n_max=1, order=order)
    got = {r.id: r.features.toArray() for r in fit(docs).collect()}
    want = tfidf(TEXTS, lambda t: [w for w in t.split() if len(w) > 1], size, order)
    assert np.allclose([got[i] for i in range(len(TEXTS))], want)


def test_latent_space_is_the_truncated_svd(spark):
    rng = np.random.default_rng(2)
    x = rng.random((12, 7)) * (rng.random((12, 7)) < 0.6)
    rows = [(i, Vectors.sparse(7, [(j, float(v)) for j, v in enumerate(r) if v])) for i, r in enumerate(x)]
    got = {r.id: np.array(r.embedding) for r in ln.latent_space(spark.createDataFrame(rows, ["id", "v"]), "id", "v", 3).collect()}
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = (u * s)[:, :3]
    want /= np.where(np.linalg.norm(want, axis=1, keepdims=True) > 0, np.linalg.norm(want, axis=1, keepdims=True), 1)
    mine = np.array([got[i] for i in range(12)])
    assert np.allclose(mine @ mine.T, want @ want.T, atol=1e-8)  # equal up to the sign of each axis


@pytest.mark.parametrize("n,v,k,want", [(3, 9, 64, 2), (20, 5, 64, 4), (20, 9, 2, 2)])
def test_dimensions_are_bounded_by_rows_and_terms(spark, n, v, k, want):
    rng = np.random.default_rng(1)
    rows = [(i, Vectors.dense(rng.random(v)).toArray().tolist()) for i in range(n)]
    df = spark.createDataFrame([(i, Vectors.sparse(v, list(enumerate(r)))) for i, r in rows], ["id", "v"])
    assert {len(r.embedding) for r in ln.latent_space(df, "id", "v", k).collect()} == {want}


def test_classifier_has_no_gradient_left(spark):
    rows = [(i, TEXTS[i % 6] + f" w{i % 7} w{i % 5}", "x" if i % 6 in (0, 2, 5) else "y") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, y_true string")
    model = ln.TextClassifier(["x", "y"], n_max=1).fit(df, "id")
    data = model.features(df).select("id", "features", "y_true").orderBy("id").collect()
    x = np.array([r.features.toArray() for r in data])
    n = len(data)
    for c in ("x", "y"):
        y = np.array([r.y_true == c for r in data], float)
        w = np.where(y == 1, n / 2 / y.sum(), n / 2 / (n - y.sum()))
        i = model.classes.index(c)
        coef = model.weights[i]
        p = 1 / (1 + np.exp(-(x @ coef + model.intercepts[i])))
        grad = (w * (p - y)) @ x / w.sum() + coef / (model.C * n)
        assert np.abs(grad).max() < 1.1e-5 and abs((w * (p - y)).sum() / w.sum()) < 1.1e-5
        assert model.gradients[i] == pytest.approx(max(np.abs(grad).max(), abs((w * (p - y)).sum() / w.sum())), abs=1e-9)
    pred = {r.id: r.y_pred for r in model.predict(df).collect()}
    assert sum(pred[i] == c for i, _, c in rows) >= 58


def test_map_signs_are_fixed(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 5)) * [5, 3, 1, 1, 1]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id int, embedding array<double>")
    got = {r.vec_id: (r.x, r.y) for r in ln.flat_map(df, "vec_id", "embedding").collect()}
    _, vecs = np.linalg.eigh(np.cov(x.T))
    lead = vecs[:, ::-1][:, :2]
    lead = lead * np.sign(lead[np.argmax(np.abs(lead), axis=0), range(2)])
    assert np.allclose([got[i] for i in range(40)], x @ lead)


def test_masked_tokens_feed_the_space(spark):
    docs = spark.createDataFrame([(1, "hi {{name}} there there"), (2, "hi there")], "id int, body string")
    got = ln.tfidf_vectors(docs, "id", "body", n_max=1, tokens=tx.masked_tokens, order="df")(docs).collect()
    assert got[0].features.size == 2


def test_classes_share_their_passes(spark):
    """Four classes take no more passes than the slowest of them alone, a few for rounding left aside; repartitioning changes nothing that shows."""
    rows = [(i, TEXTS[i % 6] + f" w{i % 7} w{i % 5}", "abcd"[i % 6 % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, text string, y_true string")
    four = ln.TextClassifier(list("abcd"), n_max=1).fit(df, "id")
    alone = [ln.TextClassifier([c], n_max=1).fit(df.repartition(3), "id") for c in "ad"]
    assert four.passes <= 1.2 * max(150, *(m.passes for m in alone))
    assert np.allclose(four.weights[[0, 3]], [m.weights[0] for m in alone], atol=5e-2)


def test_absent_class_and_unlabelled_rows(spark):
    df = spark.createDataFrame([(1, "cat cat dog", "x"), (2, "dog dog cat", "y"), (3, "cat dog", None)], "id int, text string, y_true string")
    model = ln.TextClassifier(["x", "y", "z"], n_max=1, min_df=1).fit(df, "id")
    assert {r.id: r.y_pred for r in model.predict(df).collect() if r.id < 3} == {1: "x", 2: "y"}
    assert model.gradients.max() <= model.tol


def test_term_statistics_are_the_counts_of_terms(spark, monkeypatch):
    """Rows are counted in parts of a batch; copies, null and empty texts and tokens with a blank count as in ``term_counts``."""
    texts = [*TEXTS, *TEXTS[:3], None, "the the the cat the cat", "été Straße 東京 été"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, body string").coalesce(2)
    blanks = lambda c: F.split(F.regexp_replace(c, "the ", "the cat,cat,the,"), "[, ]")
    pairs = lambda c: F.split(F.regexp_replace(c, "cat ", "the cat,"), ",")
    for rows, tokens, n in ((1, tx.word_tokens, 2), (3, tx.masked_tokens, 1), (3, blanks, 2), (500, pairs, 3)):
        monkeypatch.setattr(tv, "ARROW_ROWS", rows)
        got = {r.term: (r.df, r.total) for r in tv.term_statistics(docs, "body", tokens, n).collect()}
        want = tv.document_frequency(tv.term_counts(docs, "id", "body", tokens, n))
        assert got == {r.term: (r.df, r.total) for r in want.collect()}


def test_vectors_of_texts_without_known_terms_are_empty(spark):
    docs = spark.createDataFrame([(1, "cat dog cat"), (2, "cat dog"), (3, None), (4, ""), (5, "zebra")], "id int, body string")
    fit = ln.tfidf_vectors(docs, "id", "body")
    got = {r.id: r.features for r in fit(docs.repartition(3)).collect()}
    assert fit.size == 3 and [got[i].numNonzeros() for i in (3, 4, 5)] == [0, 0, 0]
    assert {v.size for v in got.values()} == {3} and [got[i].norm(2) for i in (1, 2)] == pytest.approx([1, 1])
    assert got[1].numNonzeros() == 3


def test_fit_leaves_no_blocks_behind(spark):
    """Passes read blocks that are kept as Python reads them, until the fit has ended."""
    df = spark.createDataFrame([(i, TEXTS[i % 6], "xy"[i % 2]) for i in range(600)], "id int, text string, y_true string").coalesce(1)
    read, packed = [], ln._packer
    def packer(rows, array, arrow):
        read.append(rows)
        return packed(rows, array, arrow)
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    kept = set(glob.glob(os.path.join(os.path.dirname(tables.scratch(spark, "x")), "blocks-*")))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ln, "_packer", packer)
        model = ln.TextClassifier(["x", "y"], n_max=1).fit(df, "id")
    assert model.gradients.max() <= model.tol and max(read) <= 256
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before
    assert set(glob.glob(os.path.join(os.path.dirname(tables.scratch(spark, "x")), "blocks-*"))) <= kept

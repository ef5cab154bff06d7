"""Ranked search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm.search import Run, length_norm, rank_documents, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, top):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(1 for _, c in counts if c)
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(i, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(120)] + ["Ünder", "ünder", "É", "x-y", "A9"])
    chance = 1 / np.arange(1, len(words) + 1)
    draw = lambda n: " ".join(rng.choice(words, n, p=chance / chance.sum()))
    docs = [(i, draw(rng.integers(1, 60)), "a") for i in range(400)]
    docs += [(500, None, "a"), (501, "", None), (502, " .;- ", "a"), (None, draw(20), "a"), (7, docs[7][1], "a"), (503, "w1 " * 9000, "b")]
    items = [(i, draw(rng.integers(1, 30))) for i in range(25)] + [(90, None), (91, "?!"), (92, "unseen"), (None, "w3 w4"), (3, "w110 w111"), (93, " ".join(words[:110]))]
    return docs, items


def frames(spark, documents, corpus):
    docs, items = corpus
    return documents(docs), spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score long")


@pytest.mark.parametrize("limits", [{}, {"most": 300}, {"terms": 40, "most": 1000}])
def test_all_of_the_best(spark, documents, corpus, limits):
    docs, items = frames(spark, documents, corpus)
    got = rank_documents(docs.repartition(3), items, 12, **limits)
    assert found(got) == plain([(d, t) for d, t, _ in corpus[0]], corpus[1], 12)


def test_fewer_than_asked_for(spark, documents, corpus):
    docs, items = frames(spark, documents, corpus)
    assert found(rank_documents(docs, items, 1000)) == plain([(d, t) for d, t, _ in corpus[0]], corpus[1], 1000)


def test_ties_by_doc_id(spark, documents):
    docs = documents([(i, "one two", "a") for i in (9, 3, 7, 1, 5)] + [(2, "other", "a")])
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert [(r["rank"], r["doc_id"]) for r in rank_documents(docs.repartition(4), items, 3).orderBy("rank").collect()] == [(1, 1), (2, 3), (3, 5)]


def test_masks_are_left_out_only_when_they_cannot_matter():
    """Few masks are scored, and the result is that of scoring all of them."""
    rng = np.random.default_rng(6)
    n, size = 3000, 90
    has = rng.random((n, size)) < 1 / np.arange(1, size + 1) ** 0.7
    owner, term = np.nonzero(has)
    tf = rng.integers(1, 5, len(owner))
    run = Run(rng.integers(20, 200, n), owner, term, tf, size, n, 100 * n)
    w = weight(n, has.sum(axis=0))
    asked = np.arange(0, size)
    scored = []
    whole = run.scores

    def counted(rows, held):
        scored.append(len(rows))
        return whole(rows, held)

    run.scores = counted
    rows, scores = run.best(asked, w, 10, 0)
    every = whole(np.arange(n), [(*run.rows(t), x) for t, x in zip(asked, w)])
    assert sorted(scores)[::-1][:10] == sorted(every)[::-1][:10] and (every[rows] == scores).all()
    assert sum(scored) < n / 2


def test_large_products():
    n = np.array([1, 10**9, 5])
    assert length_norm(n, 10**10, 10**12).tolist() == [50 + 50 * int(x) * 10**10 // 10**12 for x in n]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([("a", "one")], "item_id string, text string")
    assert rank_documents(documents([]), items).collect() == []
    got = rank_documents(documents([(1, "one", "a")]), items.where(F.lit(False)))
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["item_id"] == "string"

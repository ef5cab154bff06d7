"""Near-duplicates against brute force, with groups that need several blocks."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import near_duplicates as nd

SCHEMA = "doc_id long, text string, sign string"


def brute(rows, percent=85):
    def shingles(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {d: shingles(t) for d, t in rows}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return sorted((d, len(s), root(d), root(d) == d) for d, s in sets.items())


def noisy_copies(n, words, edits, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(words)] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def result(spark, rows, percent=85):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    return sorted(tuple(r) for r in nd.link_components(df, percent).collect())


@pytest.mark.parametrize("block", [1024, 16])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "SMALL", 1024 if block > 16 else 8)
    texts = noisy_copies(90, 120, 5, 1) + noisy_copies(40, 300, 12, 2) + ["a b c", "A B C", "a b c d", "", None, "  \n", "one", "word " * 3000, "word " * 5000]
    rows = list(zip(range(100, 100 + len(texts)), texts))
    assert result(spark, rows) == brute(rows)


def test_ties_repeats_and_empty_table(spark):
    rows = [(3, "x y z a b c"), (3, "x y z a b c"), (2, "x y z a b c")]
    assert result(spark, rows) == [(2, 2, 2, True), (3, 2, 2, False), (3, 2, 2, False)]
    assert result(spark, []) == []


def test_two_texts_of_one_id(spark):
    """Rows are documents: brute force over row numbers, ids joined at the end."""
    a, b = noisy_copies(3, 100, 1, 5), noisy_copies(3, 100, 1, 6)
    rows = [(1, a[0]), (1, b[0]), (2, a[1]), (3, b[1]), (7, a[2]), (7, a[2]), (7, b[2]), (9, "left alone here by all others"), (9, ""), (9, None), (4, "x y z"), (4, "p q r")]
    found = brute(list(enumerate(t for _, t in rows)))
    least = {}
    for n, _, c, _ in found:
        least[c] = min(least.get(c, 10 ** 9), rows[n][0])
    want = sorted((rows[n][0], size, least[c], rows[n][0] == least[c]) for n, size, c, _ in found)
    assert result(spark, rows) == want
    assert {(r[0], r[2]) for r in want} == {(1, 1), (2, 1), (3, 1), (7, 1), (9, 9), (4, 4)}


def test_null_id(spark):
    df = spark.createDataFrame([(None, "x y z", ""), (1, "q r s", ""), (None, "Q R S", ""), (None, None, ""), (None, "u v", ""), (None, "U V", "")], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.link_components(df).collect()), key=str)
    assert got == sorted([(None, 1, None, True)] * 3 + [(1, 1, 1, True), (None, 1, 1, False), (None, 0, None, True)], key=str)
    named = nd.grouped(df.withColumn("group", F.col("text")), 80, keep=["sign"]).collect()
    assert len({r["group"] for r in named}) == 4 and {r.sign for r in named} == {""}

"""Katz model with vocabularies larger than the cached words: the results don't depend on what is cached."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import katz

from .test_katz import held, plain_scores, tokens


def rows_of(n):
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(80)]
    line = lambda k: " ".join(vocab[min(int(rnd.expovariate(0.08)), 79)] for _ in range(k))
    rows = [(i, line(rnd.randrange(30)) + rnd.choice(["", f" Once{i}", f" new{i} new{i} v3"])) for i in range(n)]
    return rows + [(900, None), (901, "never seen " * 50), (903, "same words"), (903, "same words"), (904, "v1 " * 3000), (None, "v1 v2")]


def plain_all_words(rows):
    """Katz scores from the definitions where all training words are in the vocabulary."""
    train = [[*tokens(t), "</s>"] for d, t in rows if not held(d)]
    uni = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    total = sum(uni.values())
    f, pf = katz.good_turing(Counter(uni.values())), katz.good_turing(Counter(pairs.values()))
    disc = lambda c, f: c * f[min(c, katz.MOST + 1)]
    p = {w: disc(c, f) / total for w, c in uni.items()}
    unseen = 1 - sum(p.values())
    assert unseen > 1e-6
    by = {}
    for (h, w), c in pairs.items():
        by.setdefault(h, {})[w] = c
    out = []
    for d, t in rows:
        score, h = 0.0, "<s>"
        for w in [*tokens(t), "</s>"]:
            ws = by.get(h, {})
            n, used, lower = sum(ws.values()), sum(disc(c, pf) for c in ws.values()), sum(p[x] for x in ws)
            n = n + 1 if n - used < 1e-9 else n
            score += math.log10(disc(ws[w], pf) / n if w in ws else (1 - used / n) / (1 - lower) * p.get(w, unseen))
            h = w
        out.append((str(d), round(score, 6)))
    return sorted(out)


def scores(spark, documents, rows, **more):
    return sorted((tuple(r) for r in katz.score_documents(documents([(d, t, "s") for d, t in rows]), **more).collect()), key=str)


@pytest.mark.parametrize("cached,frequent,per_part", [(0, 1 << 16, 2_000_000), (12, 20, 200)])
def test_words_beyond_the_cache(spark, documents, monkeypatch, cached, frequent, per_part):
    for name, value in (("CACHED", cached), ("FREQUENT", frequent), ("PER_PART", per_part)):
        monkeypatch.setattr(katz, name, value)
    rows = rows_of(100)
    got, want = scores(spark, documents, rows), plain_scores(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("cached,per_part", [(1 << 19, 2_000_000), (12, 200)])
def test_words_that_occur_once(spark, documents, monkeypatch, cached, per_part):
    monkeypatch.setattr(katz, "CACHED", cached)
    monkeypatch.setattr(katz, "PER_PART", per_part)
    rows = rows_of(100)
    assert np.allclose([x for _, x in sorted((str(g[0]), round(g[6], 6)) for g in scores(spark, documents, rows, min_count=1))],
                       [x for _, x in plain_all_words(rows)], rtol=0, atol=2e-6)


@pytest.mark.parametrize("cached", [0, 12])
def test_one_sum_a_text_whatever_tasks_hold_its_pairs(spark, documents, monkeypatch, cached):
    """The joins by word spread a text's pairs over all tasks; their sums still leave the grouped step as one row a text."""
    monkeypatch.setattr(katz, "CACHED", cached)
    monkeypatch.setattr(katz, "FREQUENT", 20)
    made, inner = spark.sparkContext.accumulator(0), katz._text_scores

    def counted(table):
        out = inner(table)
        made.add(out.num_rows)
        return out

    monkeypatch.setattr(katz, "_text_scores", counted)
    rows = [(i, t) for i, t in rows_of(100) if i is not None and i < 900]
    docs = documents([(d, t, "s") for d, t in rows])
    katz.score_documents(docs).collect()
    assert 0 < made.value <= len(rows)


def test_buckets_hold_every_sum_once():
    key, value = np.array([7, -3, 7, 11, 1 << 60], np.int64), np.array([1.0, 2.0, 4.0, 8.0, 16.0])
    got = [katz._in_buckets(key, value, b) for b in (1, 2, 50)]
    for t in got:
        pairs = [(k, v) for a, b in zip(t["texts"].to_pylist(), t["sums"].to_pylist()) for k, v in zip(np.frombuffer(a, np.int64), np.frombuffer(b))]
        assert sorted(pairs) == sorted(zip(key, value)) and len(set(t["bucket"].to_pylist())) == t.num_rows
    assert katz._in_buckets(key[:0], value[:0], 4).num_rows == 0

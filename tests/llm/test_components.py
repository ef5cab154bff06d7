"""Connected components and batch tokenising against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import words as W
from gaugeline.llm.components import components


def brute(links):
    least = {}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for u, v in links:
        if u is None or v is None:
            continue
        least.setdefault(u, u)
        least.setdefault(v, v)
        a, b = sorted((root(u), root(v)))
        least[b] = a
    return {x: root(x) for x in least}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(300)], [(5, 5), (5, 6), (None, 3), (7, 8), (8, 7), (7, 8)],
    [(random.Random(i).randrange(400), random.Random(-i).randrange(400)) for i in range(1, 260)],
])
def test_components(spark, links):
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == brute(links)


def test_words_and_pieces():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abAB \t\n\x0b\x1cé z") for _ in range(rnd.randrange(60))) for _ in range(200)] + ["", None, "x", " "]
    column = pa.array(texts + ["zzz"]).slice(0, len(texts))
    by_hash, seen = {}, []
    for at, data, bounds in W.pieces(column, 100):
        h, text, starts, ends = W.words(data, bounds)
        for x, i, a, b in zip(h.tolist(), text.tolist(), starts.tolist(), ends.tolist()):
            word = W.LOWER[data[a:b]].tobytes()
            assert by_hash.setdefault(word, x) == x
            seen.append((at + i, word))
    lower = ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    assert seen == [(i, w.encode()) for i, t in enumerate(lower) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert len(set(by_hash.values())) == len(by_hash)


def test_shingles_of_short_and_long_texts():
    texts = ["a b c d e f", "a b c", "", "A B C", "a b c d e", "b c d e f"]
    data, bounds = W.utf8(pa.array(texts))
    word, text, _, _ = W.words(data, bounds)
    h, owner = W.shingles(word, text, len(texts), 5)
    sets = [set(h[owner == i].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1, 1]
    assert sets[1] == sets[3] and sets[0] == sets[4] | sets[5] and not sets[1] & sets[0]
    assert np.array_equal(*[np.sort(W.distinct(owner, x)[1]) for x in (h, h)])

"""Repeated strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest

from gaugeline.llm import repeated_spans as rs
from gaugeline.sources.tables import table


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, length):
    return sorted((tuple(r) for r in rs.remove_repeats(df, length).drop("kept").collect()), key=str)


def test_deep_shallow_order():
    rnd = random.Random(5)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(90))) for _ in range(300)]
    strings += [b"a" * 70 + bytes(rnd.choice(b"xyz") for _ in range(rnd.randrange(30))) for _ in range(200)]
    import numpy as np
    rows, size = rs._matrix(strings, 104)
    rank, shared = rs.deep_shallow(rows, size)
    order = np.argsort(rank)
    placed = [strings[i].ljust(104, b"\0") for i in order]
    assert placed == sorted(placed)
    for r in range(1, len(order)):
        assert shared[r] == rs.common(strings[order[r - 1]], strings[order[r]])


@pytest.mark.parametrize("hot,often", [(200_000, 64), (3, 64), (200_000, 2), (3, 2)])
def test_brute_force(spark, monkeypatch, hot, often):
    monkeypatch.setattr(rs, "HOT", hot)
    monkeypatch.setattr(rs, "OFTEN", often)
    rnd = random.Random(3)
    new = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    passage, other = new(150), new(64)
    rows = [(i, new(rnd.randrange(200)) + rnd.choice([passage, other, passage[20:120], ""]) + new(rnd.randrange(300))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "ab" * 400), (103, "x" * 64), (104, "x" * 64), (105, "x" * 63), (106, ""), (107, None),
             (108, passage + new(100) + passage), (108, passage + new(100) + passage), (None, other + "q")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")
    assert got(df, 64) == brute(rows, 64)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs, 200) == brute(rows, 200)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string"), 200) == []

"""Pfair mixing: bound on the deviation, whole output, odd inputs."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import mixing as mx
from gaugeline.sources.tables import table


def plain(weights, slots):
    """Earliest deadline first, slot by slot over all sources, with fractions: (source, block) of each slot."""
    total = sum(map(Fraction, weights.values()))
    w = {s: Fraction(x) / total for s, x in weights.items()}
    had, out = Counter(), []
    for slot in range(slots):
        ready = [(math.ceil((had[s] + 1) / w[s]), i, s) for i, s in enumerate(w) if math.floor(had[s] / w[s]) <= slot]
        out.append((min(ready)[2], had[min(ready)[2]]))
        had[out[-1][0]] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 0.334, "b": 0.333, "c": 1 / 3}, {"a": 1e-3, "b": 1}, {f"{i:02}": 1 + i ** 0.5 for i in range(40)}])
def test_schedule_is_that_of_the_plain_rule(weights):
    slots = 600
    got = sorted(mx.schedule(mx.shares(weights), dict.fromkeys(weights, slots)), key=lambda x: x[2])[:slots]
    assert [(s, k) for s, k, _ in got] == plain(weights, slots) and [t for *_, t in got] == list(range(slots))


@pytest.mark.parametrize("n", [3, 200, 2000])
def test_less_than_one_block_off_the_target(n):
    rnd, slots = random.Random(n), 10_000
    weights = {f"{i:04}": rnd.random() ** 4 + 1e-4 for i in range(n)}
    if n > 3:
        weights["0000"] = sum(weights.values()) / 2  # a third of all
    total = sum(map(Fraction, weights.values()))
    had, seen = {s: [] for s in weights}, 0
    for s, k, slot in mx.schedule(mx.shares(weights), {s: math.ceil(slots * Fraction(w) / total) + 1 for s, w in weights.items()}):
        w = Fraction(weights[s]) / total
        assert math.floor(k / w) <= slot < math.ceil((k + 1) / w) and k == len(had[s])
        had[s].append(slot)
        seen += slot < slots
    assert seen == slots
    for s, own in had.items():
        w = Fraction(weights[s]) / total
        # the count is off the most just before and just after a block's slot
        for k, slot in enumerate(own):
            assert -1 < k - w * slot < 1 and -1 < k + 1 - w * (slot + 1) < 1
    assert all(abs(sum(t < slots for t in own) - slots * Fraction(weights[s]) / total) < 1 for s, own in had.items())


def test_a_source_that_runs_out():
    share = mx.shares({"a": 1, "b": 1, "c": 2})
    got = {(s, k): t for s, k, t in mx.schedule(share, {"a": 3, "b": 50, "c": 40})}
    assert len(got) == len(set(got.values())) == 93
    assert all(4 * k // share[s] <= t < -(-4 * (k + 1) // share[s]) for (s, k), t in got.items())


def test_shares():
    assert mx.shares({"b": 0.5, "a": 1.5, None: 1}) == {None: 2, "a": 3, "b": 1} and list(mx.shares({"b": 1, None: 1})) == [None, "b"]
    assert mx.shares({"a": 0.1, "b": 0.2})["b"] * Fraction(0.1) == mx.shares({"a": 0.1, "b": 0.2})["a"] * Fraction(0.2)
    assert mx.shares({"a": 5, "b": 0, "c": None, "d": -1.0, "e": float("nan"), "f": float("inf")}) == {"a": 5}
    assert mx.shares({}) == {}


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = mx.mix(docs, block_chars=2000).toPandas()
    length = {r.doc_id: r.n for r in docs.selectExpr("doc_id", "length(text) AS n").collect()}
    assert sorted(got.doc_id) == sorted(length)
    per_slot = got.groupby("slot").source.nunique()
    assert per_slot.max() == 1
    got["n"] = got.doc_id.map(length)
    for _, g in got.sort_values(["slot", "in_slot"]).groupby("source"):
        at = 0
        # the documents of a source follow each other without gap or overlap
        for block, inside, n in sorted(zip(g.block, g.in_slot, g.n)):
            assert block * 2000 + inside == at
            at += n
    # while no source has run out, each is less than a block off its weight, and a document may reach beyond its block
    longest = max(length.values())
    last = {s: (g.block.max(), g.weight.iloc[0]) for s, g in got.groupby("source")}
    horizon = int(min(b / w for b, w in last.values()))
    assert horizon > 50
    for t in range(1, horizon, 7):
        for s, g in got.groupby("source"):
            off = g[g.slot < t].n.sum() / 2000 - last[s][1] * t
            assert -1 < off < 1 + longest / 2000


def test_odd_rows(spark, documents):
    rows = [(1, "abc", None), (2, None, "a"), (3, "", "a"), (4, "x" * 10_000, "a"), (4, "x" * 10_000, "a"), (5, "y", "b"), (None, "z", "b")]
    got = mx.mix(documents(rows), block_chars=100).collect()
    assert len(got) == len(rows) and all(r.slot is not None for r in got)
    some = {(r.doc_id, r.source): r.slot for r in mx.mix(documents(rows), {"a": 1.0, "zz": 2.0}, 100).collect()}
    assert some[(5, "b")] is None and some[(1, None)] is None and some[(4, "a")] is not None
    assert mx.mix(documents([])).count() == 0
    assert mx.mix(documents(rows), {}).where("slot IS NOT NULL").count() == 0


def test_clashing_names_and_block_size(spark, documents, monkeypatch):
    df = documents([(i, "x" * 50, "a" if i % 3 else "b") for i in range(60)])
    for c in ("weight", "block", "slot", "in_slot"):
        df = df.withColumn(c, F.lit(-7))
    plain_rows = sorted(map(tuple, mx.mix(documents([(i, "x" * 50, "a" if i % 3 else "b") for i in range(60)]), block_chars=200).collect()))
    assert sorted(map(tuple, mx.mix(df, block_chars=200).collect())) == plain_rows
    # without a given size there are few blocks, and all documents keep a place
    monkeypatch.setattr(mx, "BLOCK_CHARS", 10)
    monkeypatch.setattr(mx, "MOST_BLOCKS", 20)
    monkeypatch.setattr(mx, "PER_RANGE", 1)
    monkeypatch.setattr(mx, "RANGES", 2)
    got = mx.mix(df).collect()
    assert len(got) == 60 and all(r.slot is not None for r in got) and len({r.slot for r in got}) <= 22 and max(r.in_slot for r in got) < 150

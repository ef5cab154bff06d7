"""Katz model: counts against plain Python, exact normalisation, scores against a plain recursion."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import katz, words as W


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def tokens(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "").split()


def plain_scores(rows):
    """Base and Katz scores from the definitions, with dictionaries."""
    train = [tokens(t) for d, t in rows if not held(d)]
    uni = Counter(w for t in train for w in t)
    total, ends = sum(uni.values()) + len(train), len(train)
    types = len(uni) + (ends > 0)
    cc = Counter(uni.values())
    cc[ends] += 1
    f = katz.good_turing(cc)
    disc = lambda c, f: c * f[min(c, katz.MOST + 1)]
    vocab = {w for w, c in uni.items() if c >= 2}
    p = {w: disc(c, f) / total for w, c in uni.items()}
    p["</s>"] = disc(ends, f) / total
    seen = sum(p.values())
    scale = 1.0 if seen < 1 - 1e-12 else total / (total + 1)
    p = {w: x * scale for w, x in p.items()}
    unseen = 1 - scale * seen
    low = {w: x for w, x in p.items() if w in vocab or w == "</s>"}
    low["<unk>"] = 1 - sum(low.values())
    cls = lambda w: w if w in vocab or w == "</s>" else "<unk>"
    pairs = Counter()
    for t in train:
        line = ["<s>", *map(cls, t), "</s>"]
        pairs.update(zip(line, line[1:]))
    pf = katz.good_turing(Counter(pairs.values()))
    by = {}
    for (h, w), c in pairs.items():
        by.setdefault(h, {})[w] = c
    dist = {}
    for h, ws in by.items():
        n, used, lower = sum(ws.values()), sum(disc(c, pf) for c in ws.values()), sum(low[w] for w in ws)
        if lower >= 1 - 1e-12:
            n, b = used, 0.0
        else:
            n = n + 1 if n - used < 1e-9 else n
            b = (1 - used / n) / (1 - lower)
        dist[h] = {w: disc(ws[w], pf) / n if w in ws else b * low[w] for w in low}
        assert abs(sum(dist[h].values()) - 1) < 1e-9
    out = []
    for d, t in rows:
        ts = [*tokens(t), "</s>"]
        count = [ends if w == "</s>" else uni.get(w, 0) for w in ts]
        base = sum(math.log10((c + 0.5) / (total + 0.5 * (types + 1))) for c in count)
        score, h = 0.0, "<s>"
        for w in ts:
            k = cls(w)
            score += math.log10(dist.get(h, low)[k])
            if k == "<unk>":
                score += math.log10(p.get(w, unseen) / low["<unk>"])
            h = k
        out.append((d, held(d), len(ts), sum(c > 0 for c in count), total, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent,per_part", [(1 << 16, 2_000_000), (20, 200)])
def test_against_plain_recursion(spark, documents, monkeypatch, frequent, per_part):
    monkeypatch.setattr(katz, "FREQUENT", frequent)
    monkeypatch.setattr(katz, "PER_PART", per_part)
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(60)]
    line = lambda n: " ".join(vocab[min(int(rnd.expovariate(0.1)), 59)] for _ in range(n))
    rows = [(i, line(rnd.randrange(40)) + rnd.choice(["", " Once" + str(i), " Ünique" + str(i)])) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "the same words"), (503, "the same words"), (504, "w1 " * 20_000), (505, "Never seen before"), (None, "w1 w2")]
    got = sorted((tuple(r) for r in katz.score_documents(documents([(d, t, "s") for d, t in rows])).collect()), key=str)
    want = plain_scores(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


def test_no_training_text(spark, documents):
    ids = [d for d in range(60) if held(d)][:3]
    got = katz.score_documents(documents([(d, "a b", "s") for d in ids])).collect()
    assert len(got) == 3 and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)
    assert katz.score_documents(documents([])).count() == 0


def test_good_turing_is_katz_where_it_can_be():
    n = {1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 70}
    f = katz.good_turing(n)
    a = 6 * 70 / 1000
    assert abs(f[1] - (2 * 400 / 1000 - a) / (1 - a)) < 1e-12 and f[6] == 1
    # the discounted counts and the mass of unseen types add up to all tokens of counts up to 5
    lost = sum(n[r] * r * (1 - f[r]) for r in range(1, 6))
    assert abs(lost - n[1]) < 1e-6
    assert (katz.good_turing({}) > 0).all()


def test_packing():
    for x in ([], [0], [5, 1 << 40, 3], list(range(1000))):
        assert katz._unpack(katz._pack(np.array(x, np.uint64))).tolist() == x
    assert W.hashes(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2]))[0] == W.hashes(np.frombuffer(b"xab", np.uint8), np.array([1]), np.array([3]))[0]

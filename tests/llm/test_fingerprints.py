"""Fingerprints: neighbours, edits and likeness against a plain re-computation."""

import hashlib
import random

import pytest

from gaugeline.llm import fingerprints as fp
from gaugeline.sources.tables import table


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (d, t), (_, n) in zip(rows, [*rows[1:], *rows[:1]]):
        t, n = t or "", n or ""
        k = len(t) // 3
        e = t[:len(t) - k] + n[:k]
        a, b, c = (fp.digest(x.encode()) for x in (t, e, n))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), a.hex(), b.hex(), 1 - fp.difference(a, b) / fp.MOST, 1 - fp.difference(a, c) / fp.MOST))
    return sorted(out, key=str)


@pytest.mark.parametrize("size,coarse", [(5_000, 1024), (7, 1024), (2, 4)])
def test_brute_force(spark, documents, monkeypatch, size, coarse):
    monkeypatch.setattr(fp, "RANGE_ROWS", size)
    monkeypatch.setattr(fp, "COARSE", coarse)
    rnd = random.Random(4)
    rows = [(rnd.randrange(10 ** 6), "".join(rnd.choice("abcdefé ") for _ in range(rnd.randrange(200)))) for _ in range(80)]
    rows += [(5, None), (-7, ""), (6, "abc"), (2 ** 40, "a" * 50_000), (77, "same text"), (77, "same text"), (78, "same text"), (None, "no id")]
    got = fp.fingerprint_documents(documents([(d, t, "s") for d, t in rows])).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_small_tables(spark, documents):
    assert fp.fingerprint_documents(documents([])).count() == 0
    one = fp.fingerprint_documents(documents([(1, "abcdef", "s")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_pieces_of_a_long_text_count_every_triplet():
    text = bytes(random.Random(1).choice(b"abcdefgh") for _ in range((1 << 20) + 5000))
    import numpy as np
    whole = fp.counts(np.frombuffer(text, np.uint8))
    assert whole.sum() == 6 * (len(text) - 4)
    assert fp.digest(text)[3:] == fp.digest(text)[3:] and fp.difference(fp.digest(text), fp.digest(text)) == 0


def test_edits_are_nearer_than_neighbours(spark):
    got = fp.fingerprint_documents(table(spark, "/root/testdata/sf0.01", "documents")).where("n_chars >= 200").toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.95
    assert ((got.near_edited >= 0) & (got.near_edited <= 1) & (got.near_next >= 0) & (got.near_next <= 1)).all()

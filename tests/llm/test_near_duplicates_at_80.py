"""The pipeline's near-duplicate stage against brute force at a similarity of 0.80."""

import random
import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline as cp  # noqa: E402

from .test_near_duplicates import brute  # noqa: E402


def test_stage_links_from_080(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(200)]
        other = list(words)
        # four spread edits change 20 of 196 shingles (0.815), five 25 (0.774)
        for k in range(4 + i % 2):
            other[20 + 35 * k] = f"e{i}x{k}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in dict(cp.STAGES)["near_duplicates"](spark, docs, "").collect())
    assert got == [d for d, _, _, kept in brute(rows, 80) if kept] and len(got) == 60

"""The pipeline, stage by stage, against brute force on a fixture, and on odd tables."""

import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline as cp  # noqa: E402
from gaugeline.llm import mixing as mx, quality as q, secrets as sec  # noqa: E402

from .test_near_duplicates import brute as near_brute  # noqa: E402
from .test_scans import brute_hits  # noqa: E402

STAGE = dict(cp.STAGES)


def clean(rnd, n=60):
    return " ".join(rnd.choice(["the", "of", "and", "river", "stone", "walked", "over", "under", "seven", "houses"]) + rnd.choice(["", "", "s", "ed"]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    rnd = random.Random(8)
    items = [(i, clean(rnd, 14)) for i in range(5)]
    docs = [(i, clean(rnd, rnd.randrange(30, 90)), f"s{i % 3}") for i in range(60)]
    docs += [(100 + i, (clean(rnd, 20) + " ").upper().replace(" ", "!! "), "s0") for i in range(25)]  # junk
    docs += [(200 + i, docs[i][1], "s1") for i in range(5)] + [(210, docs[7][1] + " more", "s2")]
    docs += [(300 + i, clean(rnd) + " " + items[i][1] + " " + clean(rnd), "s2") for i in range(5)]
    docs += [(400 + i, clean(rnd) + f" token = 'abcdef{i}23456789' é " + clean(rnd), None) for i in range(4)]
    docs += [(500, None, "s0"), (501, "", "s0"), (3, docs[3][1], "s0"), (None, clean(rnd), "s1"), (502, clean(rnd, 20_000), "s1")]
    labels = [(d, int(not 100 <= d < 125)) for d, _, _ in docs if d is not None and d < 200 and d % 3]
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(d, t, "en", s, None if t is None else len(t), 1, "x", 2) for d, t, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, masked string, block int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(d, y, 0) for d, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, items


def key(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def test_stages_against_brute_force(spark, fixture):
    folder, docs, items = fixture
    frame = spark.read.parquet(f"{folder}/documents.parquet")

    kept = STAGE["quality"](spark, frame, folder)
    assert kept.columns == cp.COLUMNS
    scored = {r.text: r.score for r in q.score(frame, q.fit(frame, spark.read.parquet(f"{folder}/labels.parquet")), ("text",)).collect()}
    assert key(kept.collect()) == sorted(((d, t) for d, t, _ in docs if scored[t] >= 0.5), key=str)
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & set(range(100, 125)) and ids >= set(range(60)) | set(range(300, 305)) | {502, None}

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    one = STAGE["near_duplicates"](spark, kept, folder).collect()
    want = {d for d, _, _, keep in near_brute([(d, t) for d, t in rows if d is not None]) if keep}
    assert sorted(r.doc_id for r in one if r.doc_id is not None) == sorted(want) and sum(r.doc_id is None for r in one) == 1
    assert not want & set(range(200, 211)) and 3 in want

    left = spark.createDataFrame(one, frame.select(*cp.COLUMNS).schema)
    free = STAGE["decontaminate"](spark, left, folder)
    hit = {d for d, *_, bad in brute_hits([(r.doc_id, r.text) for r in one], items) if bad}
    assert key(free.collect()) == key([r for r in one if r.doc_id not in hit]) and hit == set(range(300, 305))

    masked = {r.doc_id: r for r in STAGE["mask_secrets"](spark, free, folder).collect()}
    for r in free.collect():
        raw = (r.text or "").encode()
        found = sec.find_secrets(raw)
        got = masked[r.doc_id]
        assert got.text == (sec.mask(raw, found).decode() if found else r.text) and got.n_chars == (len(got.text) if found else r.n_chars)
        assert (400 <= (r.doc_id or 0) < 404) == bool(found) and (got.lang, got.source) == (r.lang, r.source)

    last = spark.createDataFrame(list(masked.values()), left.schema)
    assert sorted(map(str, STAGE["mix_sources"](spark, last, folder).collect())) == sorted(map(str, mx.mix(last).collect()))


def test_near_duplicates_lose_no_text(spark):
    rnd = random.Random(4)
    a, b, c, d = (clean(rnd, 80) for _ in range(4))
    rows = [(1, a, "x"), (1, b, "y"), (2, a + " more", "x"), (3, b, "x"), (None, c, "x"), (None, c, "x"), (None, c + " end", None), (None, d, "x"), (5, d, "x"),
            (6, None, "x"), (6, "", "x"), (6, " \n", None), (None, None, None)]
    docs = spark.createDataFrame([(i, t, None, s, None, 0, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, kept int, __c int").withColumn("group", F.lit(1))
    got = sorted(((r.doc_id, r.text, r.source) for r in STAGE["near_duplicates"](spark, docs, "").collect()), key=str)
    of_c = [r for r in got if r[1] in (c, c + " end")]
    assert len(of_c) == 1 and of_c[0][0] is None
    assert sorted([r for r in got if r not in of_c], key=str) == sorted([(1, a, "x"), (1, b, "y"), (5, d, "x"), *rows[9:]], key=str)


def test_run_is_the_stages_in_order(spark, fixture):
    folder, _, _ = fixture
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
    got = cp.run(spark, folder).collect()
    assert sorted(map(str, got)) == sorted(map(str, docs.collect())) and len(got) > 60
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "mask_secrets", "mix_sources"]


def test_empty_tables(spark, fixture):
    folder, _, _ = fixture
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, none, folder).count() == 0

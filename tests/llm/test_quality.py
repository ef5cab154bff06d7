"""Quality classifier: held-out accuracy, blindness to other columns, odd inputs."""

import numpy as np

from gaugeline.llm import quality as q
from gaugeline.sources.tables import table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    got = q.classify(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    import zlib
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert len(held) > 100
    rank, n1 = held.score.rank(), (held.quality == 1).sum()
    auc = (rank[held.quality == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (held.quality == 0).sum()
    assert auc > 0.97 and (held.predicted == held.quality).mean() > 0.95
    # the held-out labels have no say
    flipped = labels.withColumn("quality", q.F.when(q.in_fold(q.F.col("doc_id")), 1 - q.F.col("quality")).otherwise(q.F.col("quality")))
    again = q.classify(docs, flipped).toPandas().merge(got, on="doc_id")
    assert (again.score_x == again.score_y).all()


def test_only_the_text_counts(spark, documents):
    rows = [(i, "words of a text " * (i + 1), "a") for i in range(6)] + [(6, None, "a"), (7, "", "b"), (8, "x" * 300_000, "b"), (8, "x" * 300_000, "c"), (None, "", "c")]
    labels = spark.createDataFrame([(0, 1, 0, "z"), (2, 0, 1, "z"), (2, 1, 0, "z"), (None, 1, 0, "z"), (3, None, 0, "z")], "doc_id long, quality int, toxic int, score string")
    got = q.classify(documents(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[8]) == 1 and by_text[6] == by_text[7] == by_text[None]


def test_no_labels_and_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.classify(documents([(1, "a b", "s")]), none).collect()} == {0.5}
    assert q.classify(documents([]), none).count() == 0


def test_dot_product_is_a_plain_sum():
    rnd = np.random.default_rng(1)
    weights = rnd.normal(size=q.BUCKETS)
    data, bounds = q.W.utf8(q.pa.array(["one two two THREE!", "", "x"]))
    text, bucket, value = q.features(data, bounds)
    want = [weights[0] + sum(weights[b] * v for t, b, v in zip(text, bucket, value) if t == i) for i in range(3)]
    assert np.allclose(q.scores(weights, data, bounds), 1 / (1 + np.exp(-np.array(want))))

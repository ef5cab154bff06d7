"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

A text is read as two streams of tokens: its lower-cased words, and their forms (capitals, digits,
signs, length, whether the word repeats the one before).  Runs of one and two words and of one to three
forms are hashed into ``BUCKETS`` weights.  A feature's value is its count over the square root of all runs of its
stream, so the score is a sparse dot product in which a text of a few words stays near the bias.

The fit reads at most ``sample`` labelled texts, those with the least hash of their id, in one task
(the only bounded step, 20,000 by default); scoring reads every text, with the weights broadcast (2 MB).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable

BUCKETS = 1 << 18
SAMPLE = 20_000
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-4, 1e-4, 3


def _forms(data, starts, ends, word):
    """Form of every word, a small number."""
    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    lower = (data >= 97) & (data <= 122) | (data >= 128)
    sign = ~(upper | digit | lower)

    def share(kind):
        total = np.concatenate([[0], np.cumsum(kind)])
        return np.minimum(total[ends] - total[starts], 3)

    size = np.searchsorted([3, 6, 12, 24], ends - starts)
    same = np.zeros(len(word), np.int64)
    same[1:] = word[1:] == word[:-1]
    last = np.where(sign[ends - 1], data[ends - 1], 0).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    form = share(upper) + 4 * (share(digit) + 4 * (share(sign) + 4 * (np.minimum(share(lower), 1) + 2 * (size + 8 * (same + 2 * last)))))
    return W.mix(form.astype(np.uint64) + np.uint64(1 << 40))


def features(data: np.ndarray, bounds: np.ndarray):
    """(text, bucket, value) of all runs in a piece of texts, repeats not yet summed."""
    word, text, starts, ends = W.words(data, bounds)
    form = _forms(data, starts, ends, word)
    texts, buckets, values = [], [], []
    for k, (stream, n) in enumerate(((word, 1), (word, 2), (form, 1), (form, 2), (form, 3))):
        kept = max(0, len(stream) - n + 1)
        h = np.full(kept, k + 1, np.uint64)
        for i in range(n):
            h = h * W.BASE + stream[i:i + kept]
        inside = text[:kept] == text[n - 1:n - 1 + kept]
        owner = text[:kept][inside]
        count = np.bincount(owner, minlength=len(bounds) - 1)
        texts.append(owner)
        buckets.append((W.mix(h[inside]) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1)
        values.append(1.0 / np.sqrt(count[owner]))
    return np.concatenate(texts), np.concatenate(buckets), np.concatenate(values)


def scores(weights: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    text, bucket, value = features(data, bounds)
    sums = weights[0] + np.bincount(text, weights=weights[bucket] * value, minlength=len(bounds) - 1)
    return 1 / (1 + np.exp(-np.clip(sums, -50, 50)))


def _weights(z, n):
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _train(batches):
    """One task over the sample: follow the regularised leader, a text at a time."""
    table = pa.Table.from_batches(list(batches), pa.schema([("y", pa.int64()), ("text", pa.string())]))
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    y = table.column("y").to_numpy().astype(float)
    for _ in range(EPOCHS):
        for at, data, bounds in W.pieces(table.column("text")):
            text, bucket, value = features(data, bounds)
            order = np.argsort(text, kind="stable")
            cut = np.searchsorted(text[order], np.arange(len(bounds)))
            for i in range(len(bounds) - 1):
                own = order[cut[i]:cut[i + 1]]
                names, turn = np.unique(bucket[own], return_inverse=True)
                x = np.concatenate([[1.0], np.bincount(turn, weights=value[own], minlength=len(names))])
                names = np.concatenate([[0], names])
                w = _weights(z[names], n[names])
                p = 1 / (1 + np.exp(-np.clip(w @ x, -50, 50)))
                g = (p - y[at + i]) * x
                z[names] += g - (np.sqrt(n[names] + g * g) - np.sqrt(n[names])) / ALPHA * w
                n[names] += g * g
    w = _weights(z, n)
    has = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(w[has])], names=["bucket", "weight"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most ``sample`` rows of labels (doc_id, quality) whose text is in ``docs``.

    Labels without id or quality are ignored, of repeated ids the greater label counts.  Without any label
    all weights are 0 and every score is 0.5.
    """
    chosen = (labels.select("doc_id", F.col("quality").cast("long").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = importable(docs).select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    found = (texts.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text").select("y", "text")
             .mapInArrow(_train, "bucket long, weight double").toArrow())
    weights = np.zeros(BUCKETS)
    weights[found.column("bucket").to_numpy()] = found.column("weight").to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, keep=("doc_id",), name: str = "score") -> DataFrame:
    """The ``keep`` columns and the score of every whole text, from 0 to 1; a null text is empty and gets the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            for at, data, bounds in W.pieces(batch.column(0)):
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays([*[c.slice(at, n) for c in batch.columns[1:]], pa.array(scores(shared.value, data, bounds))],
                                                 names=[*batch.schema.names[1:], name])

    df = importable(docs).select(F.col("text").cast("string").alias("__text"), *[F.col(c) for c in keep])
    return df.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes[1:]) + f", `{name}` double")


def in_fold(doc_id) -> F.Column:
    """crc32(doc_id as text) mod 3 = 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Learns only from labels outside the held-out fold.  Texts alone are read for a score.  Repeated rows
    get equal scores; extra columns are ignored.
    """
    weights = fit(docs, labels.where(~in_fold(F.col("doc_id"))), sample)
    out = score(docs, weights)
    return out.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

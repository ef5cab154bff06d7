"""Fitted models: linear text classifier, latent semantic space, 2-D map."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import StorageLevel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import unwrap_udt
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from gaugeline.functions.text import word_tokens
from gaugeline.operators.textvec import ARROW_ROWS, gram_finder, term_statistics, vocabulary, with_idf
from gaugeline.sources.tables import discard, stored


def tfidf_vectors(train: DataFrame, key: str, text: str, max_features=20000, n_max=2, min_df=2, tokens=word_tokens, order="total"):
    """Fit vocabulary and smoothed idf + 1; returns a function frame -> features.

    The vocabulary is the ``max_features`` terms of highest total count (or document
    frequency, ``order="df"``); that capped list is all that reaches the driver.
    """
    n = train.agg(F.count("*")).scalar()
    stats = term_statistics(train, text, tokens, n_max)
    vocab = with_idf(vocabulary(stats, max_features, min_df, order=order), n)
    terms = vocab.select("term", "idf").collect()
    sent = train.sparkSession.sparkContext.broadcast(([t["term"] for t in terms], np.array([t["idf"] for t in terms])))
    vector = F.arrow_udf(_weigher(sent, gram_finder(n_max), ARROW_ROWS, np, pa), VectorUDT())

    def features(df):
        return df.withColumn("features", vector(tokens(F.col(text))))

    features.size = len(terms)
    return features


def _weigher(sent, grams, rows: int, array, arrow):
    """Token lists to sparse vectors of length 1, as Spark stores them; without known terms a vector is empty."""
    def part(tokens):
        vocab, idf = sent.value
        size = max(len(vocab), 1)
        terms, row, term = grams(tokens)
        place = arrow.compute.index_in(terms, value_set=arrow.array(vocab, arrow.string()))
        place = place.fill_null(-1).to_numpy(zero_copy_only=False)[term]
        key, tf = array.unique((row * size + place)[place >= 0], return_counts=True)
        row, place = array.divmod(key, size)
        weight = tf * idf[place]
        norm = array.sqrt(array.bincount(row, weight * weight, minlength=len(tokens)))
        ends = arrow.array(array.searchsorted(row, array.arange(len(tokens) + 1)).astype("<i4"))
        kind, length = arrow.array(array.zeros(len(tokens), "i1")), arrow.array(array.full(len(tokens), len(vocab), "<i4"))
        lists = (arrow.ListArray.from_arrays(ends, arrow.array(x)) for x in (place.astype("<i4"), weight / norm[row]))
        return arrow.StructArray.from_arrays([kind, length, *lists], names=["type", "size", "indices", "values"])

    def weigh(tokens: arrow.Array) -> arrow.Array:
        return arrow.concat_arrays([part(tokens.slice(at, rows)) for at in range(0, max(len(tokens), 1), rows)])

    return weigh


def _packer(rows: int, array, arrow):
    """Rows (label index, ids, vals) as blocks of at most ``rows`` rows in four arrays."""
    def pack(batches):
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.slice(at, rows)
                ids, vals = part.column("ids"), part.column("vals")
                blobs = (part.column("y").to_numpy().astype("<i4"), array.diff(ids.offsets.to_numpy()).astype("<i4"),
                         ids.flatten().to_numpy().astype("<i4"), vals.flatten().to_numpy().astype("<f8"))
                yield arrow.RecordBatch.from_arrays([arrow.array([x.tobytes()], arrow.binary()) for x in blobs], names=["y", "n", "ids", "vals"])

    return pack


def _passer(sent, weight_of, size: int, array):
    """Loss and gradient of every open class over a partition of blocks, in one pass."""
    def add(blocks):
        points = sent.value  # {class index: weights with the intercept last}
        loss, grad = {c: 0.0 for c in points}, {c: array.zeros(size + 1) for c in points}
        for y, n, ids, vals in blocks:
            y, n, ids, vals = (array.frombuffer(x, t) for x, t in ((y, "<i4"), (n, "<i4"), (ids, "<i4"), (vals, "<f8")))
            row, ids = array.repeat(array.arange(len(n)), n), ids.astype(array.intp)
            for c, w in points.items():
                margin = array.bincount(row, vals * w.take(ids), minlength=len(n)) + w[size]
                sign = array.where(y == c, 1.0, -1.0)
                share = array.where(y == c, *weight_of[c])
                loss[c] += float((share * array.logaddexp(0, -sign * margin)).sum())
                pull = -share * sign / (1 + array.exp(array.clip(sign * margin, -500, 500)))
                grad[c][:size] += array.bincount(ids, vals * pull.take(row), minlength=size)[:size]
                grad[c][size] += pull.sum()
        yield loss, grad

    return add


def _added(a, b):
    for c in a[0]:
        a[0][c] += b[0][c]
        a[1][c] += b[1][c]
    return a


class Descent:
    """One class's L-BFGS with backtracking: asks for a point, is told value and gradient there."""

    def __init__(self, size: int, memory: int = 10):
        self.at = self.trial = np.zeros(size)
        self.value = self.slope = None
        self.steps, self.memory = [], memory

    def told(self, value: float, slope: np.ndarray) -> None:
        if self.value is not None and value > self.value + 1e-4 * self.length * self.fall + 1e-15 * abs(self.value):
            self.length /= 2
        else:
            if self.value is not None:
                s, y = self.trial - self.at, slope - self.slope
                if s @ y > 1e-12 * (y @ y):
                    self.steps = [*self.steps[1 - self.memory:], (s, y, 1 / (s @ y))]
            self.at, self.value, self.slope = self.trial, value, slope
            q, back = slope.copy(), []
            for s, y, r in reversed(self.steps):
                back.append(r * (s @ q))
                q -= back[-1] * y
            if self.steps:
                s, y, r = self.steps[-1]
                q /= r * (y @ y)
            for (s, y, r), a in zip(self.steps, reversed(back)):
                q += (a - r * (y @ q)) * s
            self.direction, self.fall = -q, -(slope @ q)
            self.length = 1.0 if self.steps else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-300))
        self.trial = self.at + self.length * self.direction


class TextClassifier:
    """One-vs-rest logistic regression on TF-IDF; the highest score wins.

    Each class is weighted against the rest so that both halves count alike, and
    the penalty is 1 / (C * total weight), without feature standardisation.

    All classes are fitted together: a pass over the rows adds up the gradients of every class that is still open, task by task and then in a
    tree, so the number of passes is that of the slowest class and not their sum.  A pass sends classes x features numbers each way.
    """

    def __init__(self, classes, C=2.0, max_features=20000, n_max=2, min_df=2, max_iter=1000, tol=1e-5):
        self.classes, self.C, self.max_iter, self.tol = list(classes), C, max_iter, tol
        self.spec = dict(max_features=max_features, n_max=n_max, min_df=min_df)

    def fit(self, train: DataFrame, key: str, text="text", label="y_true"):
        self.features = tfidf_vectors(train, key, text, **self.spec)
        index = F.lit(-1)
        for i, c in enumerate(self.classes):
            index = F.when(F.col(label) == c, i).otherwise(index)
        rows = sparse_parts(self.features(train).withColumn("y", index), "y", "features")
        size = self.features.size
        files = stored(rows.where("y IS NOT NULL").mapInArrow(_packer(256, np, pa), "y binary, n binary, ids binary, vals binary"), "blocks")
        # every pass reads them as Python wants them, instead of decoding and pickling the files again
        blocks = files.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        counts = {r[0]: r[1] for r in train.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
        n = sum(counts.values())
        weight_of = {i: (n / (2.0 * max(counts.get(c, 0), 1)), n / (2.0 * max(n - counts.get(c, 0), 1))) for i, c in enumerate(self.classes)}
        total = {i: weight_of[i][0] * counts.get(c, 0) + weight_of[i][1] * (n - counts.get(c, 0)) for i, c in enumerate(self.classes)}
        penalty, sc = 1.0 / (self.C * max(n, 1)), train.sparkSession.sparkContext
        fits = {i: Descent(size + 1) for i in range(len(self.classes))}
        open_, self.passes = set(fits) if n else set(), 0
        while open_:
            if self.passes >= self.max_iter:
                raise RuntimeError(f"the fit has not converged after {self.max_iter} passes")
            sent = sc.broadcast({i: fits[i].trial for i in open_})
            loss, grad = blocks.mapPartitions(_passer(sent, weight_of, size, np)).treeReduce(_added, 2)
            self.passes += 1
            for i in list(open_):
                w = fits[i].trial.copy()
                w[size] = 0  # the intercept isn't penalised
                fits[i].told(loss[i] / total[i] + penalty / 2 * (w @ w), grad[i] / total[i] + penalty * w)
                if np.abs(fits[i].slope).max() <= self.tol:
                    open_.remove(i)
            sent.unpersist()
        blocks.unpersist()
        discard(files)
        self.weights = np.array([f.at[:size] for f in fits.values()])
        self.intercepts = np.array([f.at[size] for f in fits.values()])
        self.gradients = np.array([np.abs(f.slope).max() if f.slope is not None else 0.0 for f in fits.values()])
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with ``y_pred``; of classes with equal scores the first."""
        sent = df.sparkSession.sparkContext.broadcast((self.weights.T.copy(), self.intercepts))

        def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            weights, intercepts = sent.value
            for ids, vals in batches:
                out = np.tile(intercepts, (len(ids), 1))
                sizes = ids.map(len).to_numpy()
                has = np.flatnonzero(sizes)
                if len(has):
                    flat, value = np.concatenate(ids.to_numpy()).astype(int), np.concatenate(vals.to_numpy())
                    out[has] += np.add.reduceat(weights[flat] * value[:, None], (np.cumsum(sizes) - sizes)[has])
                yield pd.Series(list(out))

        raw = self.features(df).withColumn("__v", unwrap_udt("features"))
        scores = F.pandas_udf(score, "array<double>")(F.col("__v.indices"), F.col("__v.values"))
        best = F.array_position(F.col("__s"), F.array_max("__s")).cast("int")
        names = F.array(*[F.lit(c) for c in self.classes])
        return raw.withColumn("__s", scores).withColumn("y_pred", F.element_at(names, best)).drop("features", "__v", "__s")


def latent_space(vectors: DataFrame, key: str, features: str, k: int) -> DataFrame:
    """Rows of U*S of a truncated SVD with k = min(k, n - 1, v - 1), scaled to length 1, as arrays.

    One pass adds up the Gram matrix of the terms (vocabulary x vocabulary, so
    bounded by the vocabulary cap); its leading eigenvectors are the right
    singular vectors.  Documents are projected onto them in Arrow batches, which
    gives U*S without moving any document.
    """
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors.select(features), features))
    gram = matrix.computeGramianMatrix().toArray()
    k = max(1, min(k, matrix.numRows() - 1, len(gram) - 1))
    _, basis = np.linalg.eigh(gram)  # ascending order
    basis = basis[:, ::-1][:, :k].copy()

    def project(batches):
        for pdf in batches:
            sizes = pdf["ids"].map(len).to_numpy()
            out = np.zeros((len(pdf), basis.shape[1]))
            has = np.flatnonzero(sizes)
            if len(has):  # one sparse product for the whole batch
                ids, values = np.concatenate(pdf["ids"].to_numpy()).astype(int), np.concatenate(pdf["vals"].to_numpy())
                starts = (np.cumsum(sizes) - sizes)[has]
                for at in range(0, basis.shape[1], 16):
                    out[has, at:at + 16] = np.add.reduceat(basis[ids, at:at + 16] * values[:, None], starts)
            size = np.linalg.norm(out, axis=1, keepdims=True)
            yield pd.DataFrame({key: pdf[key], "embedding": list(out / np.where(size > 0, size, 1))})

    parts = sparse_parts(vectors, key, features)
    schema = StructType([vectors.schema[key], StructField("embedding", ArrayType(DoubleType()))])
    return parts.mapInPandas(project, schema)


def sparse_parts(vectors: DataFrame, key: str, features: str) -> DataFrame:
    """(key, ids, vals): the entries of a sparse vector column, as it stores them."""
    raw = vectors.select(key, unwrap_udt(features).alias("__v"))
    return raw.select(key, F.col("__v.indices").alias("ids"), F.col("__v.values").alias("vals"))


def flat_map(df: DataFrame, key: str, embedding: str) -> DataFrame:
    """First two principal components of an embedding array; the largest loading of a component is positive."""
    rows = df.withColumn("__v", array_to_vector(F.transform(embedding, lambda x: x.cast("double"))))
    model = PCA(k=2, inputCol="__v", outputCol="__p").fit(rows)
    loadings = model.pc.toArray()
    sign = np.sign(loadings[np.argmax(np.abs(loadings), axis=0), range(2)])
    xy = vector_to_array("__p")
    return model.transform(rows).withColumns({"x": xy[0] * float(sign[0]), "y": xy[1] * float(sign[1])}).drop("__v", "__p")

"""Ranked lexical search with presence-mask grouping.

Terms are runs of digits, letters and non-ASCII bytes, A-Z lower-cased.  A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))); a document adds
weight * ((10^9 tf) div (1000 tf + 20 m)) for each term of the item that it holds, m = 50 + (50 n N) div L, in whole numbers.

Whole texts are tokenised once.  Of every document its number of terms and the counts of the items' terms are kept, so what is written follows the
corpus; document frequencies are summed from that.  The items are the stated query set: they are dealt by hash into blocks of about half of ``TERMS``
terms (or one longer item), so no vocabulary that is sent to the tasks grows with their table.

A task takes its documents in runs of at most ``POSTINGS`` counts.  For an item, the documents of each of its terms are a bitmap over the run; turned round, they give
every document the mask of the terms it holds, and documents of one mask are a group.  With the largest count of each term in the run and the least m of the
group, a mask has a largest score that none of its documents can pass.  Masks are scored from the largest of these down,
until the item has enough documents and no other mask can reach the last of them.  A task carries its best documents from run to run, so
later runs finish sooner, and returns at most ``top`` an item.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import stored

TOP = 50
TERMS = 1 << 18
POSTINGS = 1 << 21
#: Fixed values of the score.
WEIGHT, TF, SATURATION, BASE, SLOPE = 1000, 1_000_000_000, 20, 100, 50
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, bounds: np.ndarray):
    """(hash, text) of every term, in order."""
    low = W.LOWER[data]
    starts, ends = W.spans(TERM[low], bounds)
    return W.hashes(low, starts, ends), np.searchsorted(bounds, starts, "right") - 1


def _item_terms(batches):
    """Rows (item, term) of the distinct terms of every item row."""
    for batch in batches:
        for at, data, bounds in W.pieces(batch.column("__text").cast(pa.large_binary())):
            h, text = terms_of(data, bounds)
            text, h = W.distinct(text, h)
            yield pa.RecordBatch.from_arrays([batch.column("__item").slice(at).take(pa.array(text)), pa.array(h.view(np.int64))], names=["__item", "term"])


def item_blocks(items: DataFrame, item_id: str, text: str, terms: int = TERMS) -> DataFrame:
    """Written rows (__item, terms, block): every item with its distinct terms, dealt by hash into blocks of about half of ``terms``, or one longer item."""
    rows = importable(items).select(F.to_json(F.struct(F.col(item_id).alias("id"))).alias("__item"), F.col(text).cast("string").alias("__text"))
    pairs = rows.mapInArrow(_item_terms, "__item string, term long").distinct()
    each = pairs.groupBy("__item").agg(F.array_sort(F.collect_list("term")).alias("terms"))  # an item's own terms
    sized = stored(each.withColumn("h", F.pmod(F.xxhash64("__item"), F.lit(1 << 20))), "items")
    total = sized.agg(F.sum(F.size("terms"))).first()[0] or 0
    # a block gets half of ``terms`` on average, so that few come out fuller than that
    return stored(sized.withColumn("block", F.pmod("h", F.lit(1 + 2 * total // terms))).drop("h"), "item-blocks")


def _counter(vocabulary):
    """Per document its terms in all, and the counts of the terms that some item has."""
    def count(batches):
        known = vocabulary.value
        for batch in batches:
            column = batch.column("__text").cast(pa.large_binary())
            kept = batch.drop_columns(["__text"])
            for at, data, bounds in W.pieces(column):
                n_texts = len(bounds) - 1
                h, text = terms_of(data, bounds)
                n = np.bincount(text, minlength=n_texts)
                place = np.searchsorted(known, h)
                place[place == len(known)] = 0
                hit = known[place] == h if len(known) else np.zeros(len(h), bool)
                key, tf = np.unique(text[hit] * len(known) + place[hit], return_counts=True)
                owner, term = np.divmod(key, max(1, len(known)))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_texts))]).astype(np.int32)
                arrays = [*kept.slice(at, n_texts).columns, pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(term, pa.int32())),
                          pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf, pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept.schema.names, "n", "terms", "tfs"])

    return count


def postings(docs: DataFrame, vocabulary, keep: str) -> DataFrame:
    """Written rows (keep, n, terms, tfs): whole texts, counted against one block's vocabulary."""
    df = importable(docs).select(F.col(keep).alias("__doc"), F.col("text").cast("string").alias("__text"))
    return stored(df.mapInArrow(_counter(vocabulary), f"__doc {df.dtypes[0][1]}, n long, terms array<int>, tfs array<int>"), "postings")


def _frequencies(size: int):
    def add(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df[term])], names=["term", "df"])

    return add


def weight(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(WEIGHT * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def length_norm(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents of n terms; Python numbers where 64 bits would not hold the product."""
    if len(n) and SLOPE * int(n.max()) * docs >= 1 << 63:
        return np.array([BASE - SLOPE + SLOPE * int(x) * docs // total for x in n], np.int64)
    return BASE - SLOPE + SLOPE * n * docs // max(total, 1)


def share(tf, m):
    return TF * tf // (1000 * tf + SATURATION * m)


class Run:
    """Documents of one run: the rows and counts of each term, in order of the term."""

    def __init__(self, n, owner, term, tf, size: int, docs: int, total: int):
        order = np.argsort(term, kind="stable")
        self.owner, self.tf = owner[order], tf[order].astype(np.int64)
        self.edges = np.searchsorted(term[order], np.arange(size + 1))
        self.m = length_norm(n, docs, total)
        self.size = len(n)

    def rows(self, term: int):
        a, b = self.edges[term], self.edges[term + 1]
        return self.owner[a:b], self.tf[a:b]

    def best(self, terms, weights, top: int, least: int):
        """(rows, scores) that hold all documents of the run with one of the ``top`` highest scores of at least ``least``."""
        held = [(i, *self.rows(t), w) for i, (t, w) in enumerate(zip(terms, weights))]
        held = [(rows, tf, w) for _, rows, tf, w in held if len(rows) and w > 0]
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mask = np.zeros((-(-len(held) // 64), self.size), np.uint64)
        for bit, (rows, _, _) in enumerate(held):
            mask[bit // 64, rows] |= np.uint64(1 << bit % 64)
        met = np.flatnonzero(mask.any(axis=0))
        order = met[np.lexsort(mask[:, met])]  # documents of one mask side by side
        own = mask[:, order]
        first = np.flatnonzero(np.concatenate([[True], (own[:, 1:] != own[:, :-1]).any(axis=0)]))
        least_m = np.minimum.reduceat(self.m[order], first)
        bound = np.zeros(len(first), np.int64)
        for bit, (_, tf, w) in enumerate(held):
            has = own[bit // 64, first] >> np.uint64(bit % 64) & np.uint64(1) != 0
            bound[has] += w * share(int(tf.max()), least_m[has])
        ahead = np.argsort(-bound, kind="stable")
        ends = np.append(first[1:], len(order))
        rows_out, scores_out, at, much = [], [], 0, top
        while at < len(ahead) and bound[ahead[at]] >= max(least, 1):
            members = np.cumsum(ends[ahead[at:]] - first[ahead[at:]])
            to = at + 1 + int(np.searchsorted(members, much))
            group = ahead[at:to][bound[ahead[at:to]] >= least]
            sizes = ends[group] - first[group]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rows = order[np.repeat(first[group], sizes) + inside]
            rows_out.append(rows)
            scores_out.append(self.scores(rows, held))
            scores = np.concatenate(scores_out)
            if len(scores) >= top:
                least = max(least, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
            at, much = to, 2 * much
        if not rows_out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, scores = np.concatenate(rows_out), np.concatenate(scores_out)
        good = (scores >= least) & (scores > 0)
        return rows[good], scores[good]

    def scores(self, rows, held):
        slot = np.full(self.size, -1, np.int64)
        slot[rows] = np.arange(len(rows))
        out = np.zeros(len(rows), np.int64)
        for owner, tf, w in held:
            at = slot[owner]
            good = at >= 0
            at = at[good]
            out[at] += w * share(tf[good], self.m[rows[at]])
        return out


def _runs(batches, most: int):
    """Slices of batches of at most ``most`` counts, or one document."""
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def _ranker(asked, size: int, docs: int, total: int, top: int, most: int):
    """``asked``: items as (id, numbers of their terms, weights of these)."""
    def rank(batches):
        items = asked.value
        best = [([], 0) for _ in items]  # (score, doc) of an item so far, and the least score that still counts
        for batch in _runs(batches, most):
            lists, tfs = batch.column("terms"), batch.column("tfs")
            counts = np.diff(lists.offsets.to_numpy())
            run = Run(batch.column("n").to_numpy(), np.repeat(np.arange(len(batch)), counts), lists.flatten().to_numpy(), tfs.flatten().to_numpy(), size, docs, total)
            ids = batch.column("__doc")
            for k, (_, terms, weights) in enumerate(items):
                have, least = best[k]
                rows, scores = run.best(terms, weights, top, least)
                if len(rows):
                    have = have + list(zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist()))
                    have.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
                    best[k] = have[:top], have[top - 1][0] if len(have) >= top else 0
        for (item, _, _), (have, _) in zip(items, best):
            if have:
                scores, ids = zip(*have)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(have)), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["__item", "__doc", "score"])

    return rank


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, item_id: str = "item_id", text: str = "text", doc_id: str = "doc_id",
                   terms: int = TERMS, most: int = POSTINGS) -> DataFrame:
    """The ``top`` documents of every item: item_id, rank (from 1), doc_id, score; fewer where fewer have a score above 0.

    Equal scores stand in order of doc_id, null first; rows of one doc_id are documents of their own.  Rows of one item_id, null included, are one
    item with the terms of all of them; an item without terms has no row.  A null or empty text has no terms and doesn't count as a
    document.  Long texts are counted whole.  Empty tables give no row.  Further columns don't matter, whatever their names.

    Terms are told apart by 64-bit hashes.  ``terms`` and ``most`` bound what a task holds and change no result.
    """
    spark = docs.sparkSession
    asked = item_blocks(items, item_id, text, terms)
    docs = docs.select(F.col(doc_id).cast("long").alias(doc_id), "text")
    out = None
    for (block,) in asked.select("block").distinct().orderBy("block").collect():
        ranked = _rank_block(spark, docs, asked.where(F.col("block") == block), doc_id, top, most)
        out = ranked if out is None else out.unionByName(ranked)
    kind = items.schema[item_id].dataType.simpleString()
    if out is None:
        out = spark.createDataFrame([], "__item string, __doc long, score long")
    order = Window.partitionBy("__item").orderBy(F.desc("score"), F.asc_nulls_first("__doc"))  # tasks send at most ``top`` rows an item
    final = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return final.select(F.from_json("__item", f"id {kind}")["id"].alias(item_id), "rank", F.col("__doc").alias(doc_id), "score")


def _rank_block(spark, docs: DataFrame, block: DataFrame, doc_id: str, top: int, most: int) -> DataFrame:
    """Items of one block, at most about ``terms`` terms, against all documents."""
    sc = spark.sparkContext
    rows = block.select("__item", "terms").collect()
    vocabulary = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in rows]).view(np.uint64))
    sent = sc.broadcast(vocabulary)  # 8 bytes a term of the block
    counted = postings(docs, sent, doc_id)
    stats = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    n, total = stats[0], stats[1] or 0
    df = np.zeros(len(vocabulary), np.int64)
    for term, c in counted.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[term] = c
    w = weight(n, df)
    items = []
    for r in rows:
        place = np.searchsorted(vocabulary, np.array(r["terms"], np.int64).view(np.uint64))
        items.append((r["__item"], place, w[place]))
    ranker = _ranker(sc.broadcast(items), len(vocabulary), n, total, top, most)
    return counted.select("__doc", "n", "terms", "tfs").mapInArrow(ranker, "__item string, __doc long, score long")

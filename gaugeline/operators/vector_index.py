"""Exact nearest vectors by cosine, from a clustered index whose cells are skipped by the triangle bound.

Vectors are scaled to length 1, so the order of cosines is that of distances.  Centres are fitted on a bounded sample; every distinct vector goes into the cell of
its nearest centre, with its distance to it.  A query first searches the nearest cells that hold ``k`` vectors; the k-th distance found bounds
the answer, so a cell whose centre is farther than that plus the cell's radius is skipped, as is, inside the other cells, a vector whose
distance to the centre differs from the query's by more.  Equal vectors are searched once: only their least keys can be in an answer.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.sources.tables import stored

#: Rows that the centres are fitted on, centres at most, rows that a task compares with its queries at once.
SAMPLE, CELLS, ROWS = 8192, 512, 8192
#: Room for rounding in the bounds, and for similarities that are ties at 9 digits.
SLACK, TIE = 1e-9, 2e-9


def _known(df: DataFrame, key: str, embedding: str, dim: int) -> DataFrame:
    """(key, vector as doubles of length 1) of the rows that have a direction."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("__key"), v.alias("__v")).where((F.size("__v") == dim) & ~F.exists("__v", lambda x: x.isNull() | F.isnan(x)))
    size = F.aggregate("__v", F.lit(0.0), lambda s, x: s + x * x)
    return rows.where(F.col("__key").isNotNull()).withColumn("__size", F.sqrt(size)).where("__size > 0").select(
        "__key", F.transform("__v", lambda x: x / F.col("__size")).alias("__v"))


def fit_centres(vectors: DataFrame, cells: int, sample: int = SAMPLE, rounds: int = 6) -> np.ndarray:
    """Centres of a bounded sample, the rows of least hash."""
    rows = vectors.select("__v").orderBy(F.xxhash64("__v")).limit(sample).collect()
    x = np.array([r[0] for r in rows])
    centres = x[:max(1, cells)].copy()
    for _ in range(rounds if len(x) else 0):
        near = np.argmax(x @ centres.T - 0.5 * (centres ** 2).sum(axis=1), axis=1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _matrix(column, dim, array):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if len(column) else array.zeros((0, dim))


def _distances(x, centres, array):
    return array.sqrt(array.maximum((x ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1) - 2 * x @ centres.T, 0))


def _assigner(centres, matrix, distances, array, arrow):
    def assign(batches):
        for batch in batches:
            d = distances(matrix(batch.column("__v"), centres.shape[1], array), centres, array)
            cell = d.argmin(axis=1) if len(d) else array.zeros(0, int)
            yield arrow.RecordBatch.from_arrays([*batch.columns, arrow.array(cell, arrow.int32()), arrow.array(d[array.arange(len(d)), cell])],
                                                names=[*batch.schema.names, "__cell", "__far"])

    return assign


def _opener(centres, sizes, radius, k, matrix, distances, array, arrow, slack):
    """Cells that a query has to search: the nearest ones with k vectors where it has no bound yet, else the others that the bound reaches."""
    def cells(batches):
        for batch in batches:
            d = distances(matrix(batch.column("__v"), centres.shape[1], array), centres, array)
            order = array.argsort(d, axis=1, kind="stable")
            held = array.cumsum(sizes[order], axis=1)
            first = array.zeros(d.shape, bool)
            array.put_along_axis(first, order, held - sizes[order] < k, axis=1)
            bounds = batch.column("__bound").to_numpy(zero_copy_only=False).astype(float)
            none = array.isnan(bounds)[:, None]
            wanted = array.where(none, first, ~first & (d <= bounds[:, None] + radius + slack)) & (sizes > 0)
            row, cell = array.nonzero(wanted)
            part = batch.take(arrow.array(row))
            yield arrow.RecordBatch.from_arrays([*part.columns, arrow.array(cell, arrow.int32()), arrow.array(d[row, cell])], names=[*part.schema.names, "__cell", "__far"])

    return cells


def _searcher(k, rows, dim, matrix, array, arrow, slack):
    """The best k vectors of one block of a cell for each of its queries."""
    def search(key, members, queries):
        out_q, out_v, out_s = [], [], []
        x, far = matrix(members.column("__v").combine_chunks(), dim, array), members.column("__far").to_numpy()
        ids = members.column("__id").combine_chunks()
        for at in range(0, queries.num_rows, 256):
            part = queries.slice(at, 256)
            q, q_far = matrix(part.column("__v").combine_chunks(), dim, array), part.column("__far").to_numpy()
            bound = part.column("__bound").to_numpy().astype(float)
            apart = array.abs(far[None, :] - q_far[:, None])
            can = array.isnan(bound)[:, None] | (apart <= bound[:, None] + slack)
            some = array.flatnonzero(can.any(axis=0))
            if not len(some):
                continue
            sims = array.where(can[:, some], array.round(q @ x[some].T, 12), -array.inf)
            # all of the k highest, with what is equal to the last of them
            cut = -array.partition(-sims, min(k, len(some)) - 1, axis=1)[:, min(k, len(some)) - 1]
            r, c = array.nonzero((sims >= cut[:, None] - 2 * slack) & (sims > -array.inf))
            out_q.append(part.column("__q").combine_chunks().take(arrow.array(r)))
            out_v.append(ids.take(arrow.array(some[c])))
            out_s.append(sims[r, c])
        if not out_q:
            return arrow.table({"__q": queries.column("__q").slice(0, 0), "__id": members.column("__id").slice(0, 0), "similarity": arrow.array([], arrow.float64())})
        return arrow.table({"__q": arrow.concat_arrays(out_q), "__id": arrow.concat_arrays(out_v), "similarity": arrow.array(array.concatenate(out_s))})

    return search


def nearest_vectors(vectors: DataFrame, queries: DataFrame, key: str, embedding: str, k: int = 5, cells: int | None = None, rows: int = ROWS) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest cosine for every row of ``queries``: key, neighbour, similarity, rank.

    Similarities that agree to 9 digits are ties, in order of the neighbour's key.  A query's own key is not among its neighbours.  Rows without a key, a vector, a
    direction or the usual number of dimensions (that of the most vectors) take no part; a repeated key is one row.  With fewer than ``k`` others all come out.
    """
    width = vectors.where(F.col(embedding).isNotNull()).groupBy(F.size(embedding).alias("d")).count().orderBy(F.desc("count"), "d").first()
    kind = vectors.schema[key].dataType.simpleString()
    if width is None or not width["d"]:
        return queries.sparkSession.createDataFrame([], f"{key} {kind}, neighbour {kind}, similarity double, rank int")
    dim = width["d"]
    known = _known(vectors, key, embedding, dim).dropDuplicates(["__key"])
    least = Window.partitionBy("__v").orderBy("__key")  # limited to k + 1 rows a vector before rows meet
    kept = known.withColumn("__r", F.row_number().over(least)).where(F.col("__r") <= k + 1)
    distinct = stored(kept.groupBy("__v").agg(F.min("__key").alias("__id"), F.array_sort(F.collect_list("__key")).alias("__keys")), "vectors")
    n = distinct.count()
    centres = fit_centres(distinct, cells or min(CELLS, int(n ** 0.5) + 1))
    assign = _assigner(centres, _matrix, _distances, np, pa)
    index = stored(distinct.select("__id", "__v").mapInArrow(assign, f"__id {kind}, __v array<double>, __cell int, __far double"), "cells")
    stats = index.groupBy("__cell").agg(F.count("*").alias("n"), F.max("__far").alias("r")).collect()  # a row a cell
    sizes, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for s in stats:
        sizes[s["__cell"]], radius[s["__cell"]] = s["n"], s["r"]
    blocks = np.maximum(1, -(-sizes // rows))
    of_cell = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("__cell") + 1)
    index = index.withColumn("__block", F.pmod(F.xxhash64("__id"), of_cell).cast("int"))
    asked = stored(_known(queries, key, embedding, dim).dropDuplicates(["__key"]), "queries")
    places = stored(asked.groupBy("__v").agg(F.min("__key").alias("__q")), "query-vectors")

    def searched(wanted: DataFrame) -> DataFrame:
        opener = _opener(centres, sizes, radius, k + 1, _matrix, _distances, np, pa, SLACK)
        opened = wanted.mapInArrow(opener, f"__q {kind}, __v array<double>, __bound double, __cell int, __far double")
        dealt = opened.withColumn("__block", F.explode(F.sequence(F.lit(0), of_cell - 1)))
        search = _searcher(k + 1, rows, dim, _matrix, np, pa, SLACK)
        return index.groupBy("__cell", "__block").cogroup(dealt.groupBy("__cell", "__block")).applyInArrow(search, f"__q {kind}, __id {kind}, similarity double")

    near = stored(searched(places.select("__q", "__v", F.lit(None).cast("double").alias("__bound"))), "near")
    best = Window.partitionBy("__q").orderBy(F.desc("similarity"))
    kth = near.withColumn("__r", F.row_number().over(best)).where(F.col("__r") == k + 1).select("__q", F.sqrt(F.greatest(2 - 2 * (F.col("similarity") - TIE), F.lit(0.0))).alias("__b"))
    # without k + 1 vectors at all a query has searched every cell; 2 is the largest distance
    bounded = places.join(kth, "__q", "left").select("__q", "__v", F.coalesce("__b", F.lit(2.0)).alias("__bound"))
    found = near.unionByName(searched(bounded))
    answers = found.join(distinct.select("__id", "__keys"), "__id").select("__q", F.explode("__keys").alias("neighbour"), F.round("similarity", 9).alias("similarity"))
    top = Window.partitionBy("__q").orderBy(F.desc("similarity"), "neighbour")
    answers = answers.withColumn("__r", F.row_number().over(top)).where(F.col("__r") <= k + 1)
    owners = asked.join(places, "__v").select("__key", "__q")
    each = owners.join(answers, "__q").where("__key <> neighbour")
    mine = Window.partitionBy("__key").orderBy("__r")
    return each.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k).select(F.col("__key").alias(key), "neighbour", "similarity", "rank")

"""Bootstrap replicates with rows as units, from one array accumulator a task.

Every row has a Poisson(1) weight in every replicate, a function of the row's key, the salt and the replicate's number.  A task adds up weight and
weight times value of its rows into one array of replicates a group, block by block as a matrix product, and returns these arrays: rows are
never multiplied with replicates outside of a block, and what moves is replicates x groups numbers a task.
"""

from math import ceil, factorial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions.hashing import key_hash

#: Rows and replicates of one block of weights, and groups that a task holds before it returns what it has.
ROWS, GROUPS = 1024, 512
#: The odd factors of the mixing steps.
STEP, FIRST, SECOND = 0x9E3779B9, 0x85EBCA6B, 0xC2B2AE35
#: Poisson(1) weights by inverse cdf on 32 bits: a draw below the k-th limit weighs k; the tail above 12 has probability 6e-11.
LIMITS = [ceil(c * 2**32) for c in accumulate(0.36787944117144233 / factorial(k) for k in range(12))]


def _adder(by: int, replicates: int, rows: int, groups: int, limits, factors):
    """Sums over the batches of a task; ``by`` leading columns are the group, then low and high half of the row's hash, then the value."""
    step, first, second = (np.uint32(f) for f in factors)
    steps = np.arange(replicates, dtype=np.uint32) * step
    cuts = np.array(limits, np.uint64)
    # weights by the upper 16 bits of a draw; a range with a limit inside is marked and looked up in full
    ends = np.searchsorted(cuts, np.arange(1 << 16, dtype=np.uint64) << np.uint64(16), "right")
    lasts = np.searchsorted(cuts, (np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)) + np.uint64(0xFFFF), "right")
    table = np.where(ends == lasts, ends, 255).astype(np.uint8)

    def weights(low, high):
        z = low[:, None] + steps
        z ^= z >> np.uint32(16)
        z *= first
        z ^= high[:, None]
        z ^= z >> np.uint32(13)
        z *= second
        z ^= z >> np.uint32(16)
        w = table[z >> np.uint32(16)]
        unsure = np.nonzero(w == 255)
        w[unsure] = np.searchsorted(cuts, z[unsure].astype(np.uint64), "right")
        return w.astype(np.float32)

    def add(batches):
        held = {}

        def flush():
            for group, (sample, sums) in held.items():
                yield pa.RecordBatch.from_arrays([*sample.columns, pa.array([sums[0].tolist()]), pa.array([sums[1].tolist()])],
                                                 names=[*sample.schema.names, "__sums", "__weights"])
            held.clear()

        for whole in batches:
            for at in range(0, len(whole), rows):
                batch = whole.slice(at, rows)
                code = np.zeros(len(batch), np.int64)
                for i in range(by):
                    column = batch.column(i).dictionary_encode(null_encoding="encode")
                    _, code = np.unique(code * (len(column.dictionary) + 1) + column.indices.to_numpy(), return_inverse=True)
                low, high = (batch.column(by + i).to_numpy().astype(np.uint32) for i in (0, 1))
                value = batch.column(by + 2).to_numpy().astype(np.float64)
                order = np.argsort(code, kind="stable")
                w = weights(low[order], high[order])
                edges = [*np.flatnonzero(np.diff(code[order], prepend=-1)).tolist(), len(order)]
                for a, b in zip(edges, edges[1:]):
                    sample = batch.select(range(by)).slice(int(order[a]), 1)
                    group = tuple(sample.column(i)[0].as_py() for i in range(by))
                    if group not in held:
                        if len(held) >= groups:
                            yield from flush()
                        held[group] = sample, np.zeros((2, replicates))
                    sums = held[group][1]
                    sums[0] += value[order[a:b]] @ w[a:b]
                    sums[1] += w[a:b].sum(axis=0, dtype=np.float64)
        yield from flush()

    return add


def row_replicates(df: DataFrame, key: str, value: Column, by=(), replicates: int = 2000, salt="boot") -> DataFrame:
    """Per group and replicate ``__b``: ``__s``, the weighted sum of the values, and ``__c``, the sum of the weights.

    Rows of a null value are left out.  Rows of one key have the same weights, in all groups, so what is compared within one replicate is paired
    by key; a key should be unique within a group.
    """
    digest = F.col("__digest")
    half = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
    rows = df.where(value.isNotNull()).select(*by, key_hash(F.col(key), salt).alias("__digest"), value.cast("double").alias("__v"))
    rows = rows.select(*by, half(1).alias("__low"), half(9).alias("__high"), "__v")
    fields = "".join(f"`{n}` {t}, " for n, t in rows.dtypes[:len(by)])
    adder = _adder(len(by), replicates, ROWS, GROUPS, LIMITS, (STEP, FIRST, SECOND))
    parts = rows.mapInArrow(adder, fields + "__sums array<double>, __weights array<double>")
    each = parts.select(*by, F.posexplode(F.arrays_zip("__sums", "__weights")).alias("__b", "__x"))
    return each.groupBy(*by, "__b").agg(F.sum("__x.__sums").alias("__s"), F.sum("__x.__weights").alias("__c"))


def row_weights_sql(source: str, key: str, columns: str, replicates: int, salt: str, name: str = "wt") -> str:
    """SQL twin of the weights: (columns, b, w) for every row of a relation and replicate."""
    cases = " ".join(f"WHEN u < {limit} THEN {k}" for k, limit in enumerate(LIMITS))
    z = "4294967296::UBIGINT"
    return f"""
{name}_h AS (SELECT {columns}, md5('{salt}:' || {key}::VARCHAR) AS m FROM {source}),
{name}_0 AS (SELECT {columns}, ('0x' || substr(m, 1, 8))::UBIGINT AS lo, ('0x' || substr(m, 9, 8))::UBIGINT AS hi FROM {name}_h),
{name}_1 AS (SELECT {columns}, b, hi, (lo + b::UBIGINT * {STEP}::UBIGINT) % {z} AS z FROM {name}_0, range({replicates}) r(b)),
{name}_2 AS (SELECT {columns}, b, xor((xor(z, z >> 16) * {FIRST}::UBIGINT) % {z}, hi) AS z FROM {name}_1),
{name}_3 AS (SELECT {columns}, b, (xor(z, z >> 13) * {SECOND}::UBIGINT) % {z} AS z FROM {name}_2),
{name}_4 AS (SELECT {columns}, b, xor(z, z >> 16) AS u FROM {name}_3),
{name} AS (SELECT {columns}, b, CASE {cases} ELSE 12 END AS w FROM {name}_4)"""

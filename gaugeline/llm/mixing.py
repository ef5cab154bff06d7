"""Mixing sources to target weights with Pfair scheduling.

Each source is cut into blocks of ``block_chars`` characters.  A source of weight w has for its block k the
release time floor(k / w) and the deadline ceil((k + 1) / w).  Earliest deadline first, among the released
blocks, gives each time slot to one block; as the weights add up to 1 every deadline is met, so after t slots
a source has had w * t blocks, off by less than one.

Weights are exact fractions of whole numbers: no period, no rounding, any number of sources.  Only blocks that
exist are scheduled, so slots of a source that ran out stay empty; the others keep their windows and the
bound, and no document is dropped or repeated.

The schedule is made in the driver, a heap step a block.  Unless the caller names a block size, it grows with the
corpus, so that there are at most ``MOST_BLOCKS`` blocks and one more a source at any size; only the characters
per source are collected.

The order of documents inside a source is that of a hash.  It is counted in two steps, hash range by hash
range, so a source that holds most rows is never one task's window; the number of ranges follows the rows.
"""

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

BLOCK_CHARS = 100_000
MOST_BLOCKS = 1 << 18
RANGES, PER_RANGE = 4096, 100_000


def shares(weights: dict) -> dict:
    """Whole numbers in exactly the proportions of the weights, in order of name, null first; only finite weights above 0."""
    exact = {k: Fraction(w) for k, w in sorted(weights.items(), key=lambda kw: (kw[0] is not None, kw[0] or "")) if w and math.isfinite(w) and w > 0}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {k: int(w * scale) for k, w in exact.items()}


def schedule(share: dict, blocks: dict) -> Iterator[tuple]:
    """(source, block, slot) of the first ``blocks[source]`` blocks, earliest deadline first among the released ones; ties go to the source named first."""
    total, name = sum(share.values()), list(share)
    waiting = [(0, i, 0) for i, k in enumerate(name) if blocks.get(k, 0) > 0]  # release, source, block
    ready, slot = [], 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // share[name[i]]), i, k))
        deadline, i, k = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a deadline was missed")
        yield name[i], k, slot
        if k + 1 < blocks[name[i]]:
            heapq.heappush(waiting, ((k + 1) * total // share[name[i]], i, k + 1))
        slot += 1


def mix(docs: DataFrame, weights: dict | None = None, block_chars: int | None = None, keep=("doc_id", "source")) -> DataFrame:
    """Every row of ``docs`` with its place in the mix: the ``keep`` columns, weight, block, slot, in_slot.

    Reading in the order (slot, in_slot) follows the weights.  ``weights`` maps a source to its target; without it a source
    weighs the square root of its characters.  A source that the map lacks gets no slot (weight and slot null), as does a
    weight that is null, not finite, or 0 or less; weights should span less than 2^40, as slots are 64-bit numbers.  ``block_chars`` is
    100,000, or more where that gave over ``MOST_BLOCKS`` blocks, unless it is named here.  A null source is a source of its own.
    A null or empty text takes no room but keeps its place; a text longer than a block reaches beyond its slot.
    Repeated rows are separate documents in a stable order of their texts' hash; equal rows may swap places.
    An empty table gives an empty mix.  Columns outside ``keep`` are ignored, whatever their names; a kept column may not carry the name of a result.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.col("doc_id"), F.col("text"))
    df = docs.select(*[F.col(c) for c in keep], F.col("source").alias("__s"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("__n"),
                     order.alias("__h"), F.col("doc_id").alias("__id"))
    n_ranges = max(RANGES, docs.select().count() // PER_RANGE)
    df = df.withColumn("__r", F.pmod("__h", F.lit(n_ranges).cast("long")))
    ranges = df.groupBy("__s", "__r").agg(F.sum("__n").alias("chars"))
    chars = {r["__s"]: r["chars"] for r in ranges.groupBy("__s").agg(F.sum("chars").alias("chars")).collect()}
    if weights is None:
        weights = {s: max(c, 1) ** 0.5 for s, c in chars.items()}
    block_chars = block_chars or max(BLOCK_CHARS, -(-sum(chars.values()) // MOST_BLOCKS))
    share = shares(weights)
    total = sum(share.values())
    blocks = {s: c // block_chars + 1 for s, c in chars.items()}  # an empty text may stand at the very end
    listed = [(s, k, slot, share[s] / total) for s, k, slot in schedule(share, blocks)]
    plan = spark.createDataFrame(pd.DataFrame(listed, columns=["__t", "__k", "slot", "weight"]), "__t string, __k long, slot long, weight double") if listed else (
        spark.createDataFrame([], "__t string, __k long, slot long, weight double"))
    before = Window.partitionBy("__s").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = ranges.select(F.col("__s").alias("__t"), F.col("__r").alias("__q"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__s", "__r").orderBy("__h", "__id").rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("__at", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    of_range = (F.col("__r") == F.col("__q")) & F.col("__s").eqNullSafe(F.col("__t"))
    placed = placed.join(starts, of_range).withColumn("__pos", F.col("__at") + F.col("__start")).drop("__t", "__q")
    placed = placed.withColumn("block", F.floor(F.col("__pos") / block_chars))
    # at most MOST_BLOCKS rows and one a source
    out = placed.join(F.broadcast(plan), F.col("__s").eqNullSafe(F.col("__t")) & (F.col("block") == F.col("__k")), "left")
    return out.select(*keep, "weight", "block", "slot", F.pmod("__pos", F.lit(block_chars)).alias("in_slot"))

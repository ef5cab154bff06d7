"""Draws by rank: a directory of the keys in hash order, written once, in which a draw looks up its places.

Every key holds as many neighbouring ranks as it has rows, in the order of (hash, key).  A draw of n is n ranks out of the total, so its work
follows n: no row is hashed again for another seed, no row is sorted, and only the parts of the directory that hold a drawn rank are read.

A key's ranks are found by an equi-join.  Keys with up to 16^l rows are filed under ranges of that width, so each lies in at most two ranges and a
range of one level has at most 18 keys; a key of one row is filed under its rank itself.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeline.functions.frames import with_grid
from gaugeline.functions.hashing import key_hash
from gaugeline.operators.numbering import PLACE_BITS
from gaugeline.sources.tables import discard, stored

PER_PART = 1 << 20
WIDTH_BITS = 4


def wide_uniform(key: Column, salt) -> Column:
    """Uniform number in [0, 1) with 52 bits, so that every rank of a table of billions can be hit."""
    return F.conv(F.substring(key_hash(key, salt), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _slot(at: Column, level: Column) -> Column:
    return F.call_function("shiftright", at, level * WIDTH_BITS)


@dataclass
class RankDirectory:
    """``rows``: key, first, n, level, slot, part; ``starts``: the first rank of every part, one number for ``PER_PART`` keys."""

    spark: SparkSession
    key: str
    rows: DataFrame
    starts: list
    total: int
    levels: list

    def look_up(self, picks: DataFrame, at: str = "at") -> DataFrame:
        """The rows of ``picks`` with the key that holds rank ``at``; ranks outside 0 .. total - 1 are left out.

        ``picks`` may not have columns named like the key, ``__part``, ``__level``, ``__slot``, ``__first`` or ``__n``.
        """
        picks = picks.where((F.col(at) >= 0) & (F.col(at) < self.total))
        starts = F.array(*[F.lit(s).cast("long") for s in self.starts])
        part = F.size(F.filter(starts, lambda s: s <= F.col(at))) - 1
        asked = with_grid(picks.withColumn("__part", part), "__level", self.levels or [0])
        asked = asked.withColumn("__slot", _slot(F.col(at), F.col("__level")))
        hit = [r[0] for r in asked.select("__part").distinct().collect()]  # at most one number for PER_PART keys
        rows = self.rows.where(F.col("part").isin(hit)).select(
            self.key, *[F.col(c).alias(f"__{c}") for c in ("part", "level", "slot", "first", "n")])
        found = asked.join(rows, ["__part", "__level", "__slot"])
        found = found.where((F.col("__first") <= F.col(at)) & (F.col(at) < F.col("__first") + F.col("__n")))
        return found.select(*picks.columns, self.key)


def rank_directory(df: DataFrame, key: str, salt, per_part: int = PER_PART) -> RankDirectory:
    """File the keys of ``df`` under their ranks.  Rows without a key have no rank; an empty table has no ranks.

    Rows of one key are counted before they move, so a key that holds a third of them is one row here.
    """
    spark = df.sparkSession
    keys = stored(df.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), "keys")
    parts = 1 + keys.count() // per_part
    order = [key_hash(F.col(key), salt), F.col(key)]
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("__place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__place", PLACE_BITS).cast("int")
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.sum("n").alias("size"), F.max("n").alias("most")).collect())
    starts, total = [], 0
    for r in sizes:
        starts.append(total)
        total += r["size"]
    number = {r["part"]: i for i, r in enumerate(sizes)}  # the parts that hold rows, in order
    before = Window.partitionBy("part").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("n").over(before), F.lit(0))
    filed = placed.withColumn("part", part)
    if sizes:
        index = F.create_map(*[F.lit(x) for p, i in number.items() for x in (p, i)])
        filed = filed.withColumn("part", index[F.col("part")])
        at = at + F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("part"))
    filed = filed.withColumn("first", at.cast("long"))
    # the least level whose width holds the key
    top = max((r["most"] for r in sizes), default=1)
    levels = [0]
    while 1 << (WIDTH_BITS * levels[-1]) < top:
        levels.append(levels[-1] + 1)
    level = F.lit(levels[-1])
    for l in reversed(levels[:-1]):
        level = F.when(F.col("n") <= 1 << (WIDTH_BITS * l), l).otherwise(level)
    filed = filed.withColumn("level", level)
    last = F.col("first") + F.col("n") - 1
    ends = F.array_distinct(F.array(_slot(F.col("first"), F.col("level")), _slot(last, F.col("level"))))
    filed = filed.withColumn("slot", F.explode(ends)).select(key, "first", "n", "level", "slot", "part")
    rows = stored(filed, "ranks", by="part")
    discard(placed)
    discard(keys)
    return RankDirectory(spark, key, rows, starts, total, levels)


def _tries(spark, n: int, seeds, total: int, salt) -> DataFrame:
    """(seed, place, at): the first ``n`` different ranks of a seed's endless row of random ranks, n <= total / 2.

    2n + 64 tries hold n different ranks but for a chance below 1e-15; a draw that comes out short raises.
    """
    tries = with_grid(spark.range(2 * n + 64).withColumnRenamed("id", "__try"), "seed", list(seeds))
    at = F.floor(wide_uniform(F.concat_ws(":", "seed", "__try"), salt) * total).cast("long")
    first = tries.groupBy("seed", at.alias("at")).agg(F.min("__try").alias("__try"))
    per_seed = Window.partitionBy("seed")
    ranked = first.withColumns({"place": F.row_number().over(per_seed.orderBy("__try")), "__have": F.count("*").over(per_seed)})
    guard = F.when(F.col("__have") < n, F.raise_error(F.lit("draw came out short"))).otherwise(F.lit(True))
    return ranked.where(guard).where(F.col("place") <= n).select("seed", "place", "at")


def draw_by_rank(directory: RankDirectory, n: int, seeds, salt="rank") -> DataFrame:
    """``n`` rows without replacement per seed: (seed, place, at, key), one row a drawn row.

    The rows of place <= m are the draw of size m.  Beyond half of the table the rows left out are drawn instead and ``place`` counts the
    ranks that stay; a table of fewer than ``n`` rows is drawn whole.  The ranks of a seed do not depend on the keys.
    """
    spark, total, seeds = directory.spark, directory.total, list(seeds)
    n = min(n, total)
    if 2 * n <= total:
        picks = _tries(spark, n, seeds, total, salt)
    else:
        every = with_grid(spark.range(total).withColumnRenamed("id", "at"), "seed", seeds)
        left = _tries(spark, total - n, seeds, total, salt).select("seed", "at")
        kept = every.join(left, ["seed", "at"], "left_anti")
        order = wide_uniform(F.concat_ws(":", F.lit("order"), "seed", "at"), salt)
        picks = kept.select("seed", F.row_number().over(Window.partitionBy("seed").orderBy(order, "at")).alias("place"), "at")
    return directory.look_up(picks)

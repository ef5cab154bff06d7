"""Exact order statistics of many groups and ranks at once, by refining histograms.

A rank starts with its group's whole range of values.  Every pass counts the rows of that range in ``bins`` bins, with each bin's least and largest value; the
bin in which the counts pass the rank becomes the next range.  A bin of one value settles the rank, a bin of at most ``small`` rows is sorted;
anything else is refined again.  No group is sorted or collected, and a value that a third of all rows share is one number in every pass.
Half of a pass's bins are evenly wide and half follow the logarithm, so values of any spread take few passes.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.sources.tables import stored

SMALL, BINS = 20_000, 1024
#: Above minus the logarithm of the least positive number.
DEEPEST = 745.2


def meet(rows: DataFrame, table: DataFrame, by) -> DataFrame:
    """Rows with the columns of a table of their group; null is a group like others."""
    keys = {c: f"__k{i}" for i, c in enumerate(by)}
    table = table.withColumnsRenamed(keys)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()], F.lit(True))
    return rows.join(table, same).drop(*keys.values()) if by else rows.join(F.broadcast(table))  # without groups: a row a rank


def _scale(x: Column) -> Column:
    """Rises with x, by its logarithm on both sides of 0."""
    return F.signum(x) * F.greatest(F.coalesce(F.ln(F.abs(x)), F.lit(-DEEPEST)) + DEEPEST, F.lit(0.0))


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the bin, rising with the value: 0 at the low end, ``bins`` at the high end."""
    vast = (high / 4 - low / 4) > 1e300  # the width itself may be beyond the largest number
    part = F.when(vast, F.try_divide(value / 4 - low / 4, high / 4 - low / 4)).otherwise(F.try_divide(value - low, high - low))
    wide = F.coalesce(F.try_divide(_scale(value) - _scale(low), _scale(high) - _scale(low)), F.lit(0.0))
    return (F.floor(F.least(part, F.lit(1.0)) * (bins // 2)) + F.floor(F.least(wide, F.lit(1.0)) * (bins // 2))).cast("int")


def order_statistics(df: DataFrame, by, value: str, ranks: dict, weight: str | None = None, small: int = SMALL, bins: int = BINS) -> DataFrame:
    """One row per group: ``by`` and, under each name of ``ranks``, the value at that place of the group's values in order, from 0.

    A rank is a number or a function of the column of the group's size; ``weight`` is a whole number of times that a row counts.  Null
    values and weights of 0 are left out; a rank beyond the group gives null; a group without values has no row.  NaN is larger than any number, as in Spark's
    order, and settles like any value.
    """
    by = list(by)
    times = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    rows = df.select(*by, F.col(value).cast("double").alias("__v"), times.alias("__w")).where("__v IS NOT NULL AND __w > 0")
    number = F.when(~F.isnan("__v"), F.col("__v"))
    sizes = rows.groupBy(*by).agg(F.sum("__w").alias("__n"), F.count("*").alias("__rows"), F.min(number).alias("__lo"), F.max(number).alias("__hi"),
                                  F.sum(F.when(number.isNotNull(), F.col("__w")).otherwise(0)).alias("__numbers"))
    wanted = F.array(*[F.struct(F.lit(k).alias("__name"), (r(F.col("__n")) if callable(r) else F.lit(r)).cast("long").alias("__rank")) for k, r in ranks.items()])
    targets = stored(sizes.select(*by, "__rows", "__lo", "__hi", "__numbers", "__n", F.inline(wanted)).withColumn("__below", F.lit(0).cast("long")), "ranks")
    none, inside = F.lit(None).cast("double"), (F.col("__rank") >= 0) & (F.col("__rank") < F.col("__n"))
    nan = inside & (F.col("__rank") >= F.col("__numbers"))
    settled = [targets.where(~inside | nan).select(*by, "__name", F.when(nan, F.lit(float("nan"))).otherwise(none).alias("__x"))]
    open_ = targets.where(inside & ~nan).select(*by, "__name", "__rank", "__rows", "__lo", "__hi", "__below")
    numbers, direct = rows.where(~F.isnan("__v")), []
    while True:
        settled.append(open_.where("__lo = __hi").select(*by, "__name", F.col("__lo").alias("__x")))
        direct.append(open_.where((F.col("__lo") != F.col("__hi")) & (F.col("__rows") <= small)))
        open_ = open_.where((F.col("__lo") != F.col("__hi")) & (F.col("__rows") > small))
        if open_.isEmpty():
            break
        ranges = open_.select(*by, "__lo", "__hi").distinct()
        hit = meet(numbers, ranges, by).where("__v BETWEEN __lo AND __hi")
        hist = hit.groupBy(*by, "__lo", "__hi", _bin(F.col("__v"), F.col("__lo"), F.col("__hi"), bins).alias("__bin")).agg(
            F.sum("__w").alias("__sum"), F.count("*").alias("__count"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
        upto = Window.partitionBy(*by, "__lo", "__hi").orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most bins + 1 rows
        hist = hist.withColumn("__upto", F.sum("__sum").over(upto)).withColumnsRenamed({"__lo": "__l", "__hi": "__h"})
        met = meet(open_, hist, by).where((F.col("__lo") == F.col("__l")) & (F.col("__hi") == F.col("__h")))
        left = F.col("__rank") - F.col("__below")
        met = met.where((left < F.col("__upto")) & (left >= F.col("__upto") - F.col("__sum")))
        open_ = stored(met.select(*by, "__name", "__rank", F.col("__count").alias("__rows"), F.col("__least").alias("__lo"), F.col("__most").alias("__hi"),
                                  (F.col("__below") + F.col("__upto") - F.col("__sum")).alias("__below")), "ranks")
    final = reduce(DataFrame.unionByName, direct)
    near = meet(numbers, final, by).where("__v BETWEEN __lo AND __hi")  # at most ``small`` rows a rank
    upto = Window.partitionBy(*by, "__name").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("__upto", F.sum("__w").over(upto) + F.col("__below"))
    settled.append(near.where((F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__w"))).select(*by, "__name", F.col("__v").alias("__x")))
    found = reduce(DataFrame.unionByName, settled)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("__name") == k, F.col("__x"))).alias(k) for k in ranks])


def floor_rank(share: float):
    """The place floor(share * n)."""
    return lambda n: F.floor(F.lit(share) * n)


def quantiles(df: DataFrame, by, value: str, shares: dict, weight: str | None = None, **limits) -> DataFrame:
    """Interpolated quantiles per group: between the two values around place share * (n - 1)."""
    ranks = {}
    for name, share in shares.items():
        ranks[f"__{name}_a"] = lambda n, s=share: F.floor(F.lit(float(s)) * (n - 1))
        ranks[f"__{name}_b"] = lambda n, s=share: F.ceil(F.lit(float(s)) * (n - 1))
    times = F.col(weight).cast("long") if weight else F.lit(1)
    sizes = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.sum(times).alias("__size"))
    ends = order_statistics(df, by, value, ranks, weight, **limits)
    met = meet(ends, sizes, by)

    def between(name, share):
        at = F.lit(float(share)) * (F.col("__size") - 1)
        a, b = F.col(f"__{name}_a"), F.col(f"__{name}_b")
        return (a + (b - a) * (at - F.floor(at))).alias(name)

    return met.select(*by, *[between(k, s) for k, s in shares.items()])

"""Dense running numbers over a whole table, without a window in one task.

Rows are dealt into range partitions of their order and sorted inside them; a row's place in its partition is written beside
it.  What the earlier partitions hold is one number a partition, so the second step is a broadcast of as many numbers as there are
partitions.
"""

from pyspark.sql import DataFrame, functions as F, Window

from gaugeline.sources.tables import stored

#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
PLACE_BITS = 33


def running_number(df: DataFrame, order, name: str = "number", start: int = 0, partitions: int | None = None) -> DataFrame:
    """The rows with ``name``: their place in the total order, from ``start`` without gaps.

    Rows of equal ``order`` get numbers next to each other, in no stated order: end ``order`` with a key to fix it.  The
    number of range partitions follows the shuffle partitions unless given.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = stored(ranged.sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))  # one row a partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    out = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    inside = F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return out.select(*df.columns, (inside + F.col("__before") + start).alias(name))

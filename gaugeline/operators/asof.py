"""Sort-merge as-of join: every fact with the last version that began at or before it.

Both sides are laid out together in one order (key, time, versions before facts, a hash of the fact) and dealt into ranges of it, so the facts of one
instant fall into as many ranges as they need.  Each range is read once, in order, with the last version at hand.  Facts at the start of a
range whose version began in an earlier one are filled in a second pass, from what every range says about its end: one row a
range.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.sources.tables import stored


def _filler(compute, arrow, array):
    """Last version of every fact inside a range, and one row about the range's end."""
    def fill(batches):
        task = TaskContext.get().partitionId()
        key = first = version = None  # key and last version at hand, as arrays of one row; the first key of the range
        kind = None
        for batch in batches:
            if not len(batch):
                continue
            keys, versions = batch.column("__key"), batch.column("__version")
            kind = versions.type
            if key is None:
                first = key = keys.slice(0, 1)
            before = arrow.concat_arrays([key, keys.slice(0, len(batch) - 1)])
            new = compute.not_equal(keys, before).to_numpy(zero_copy_only=False)
            is_version = batch.column("__fact").is_null().to_numpy(zero_copy_only=False)
            place = array.arange(len(batch))
            start = array.maximum.accumulate(array.where(new, place, -1))  # where the row's key begins in this batch
            last = array.maximum.accumulate(array.where(is_version, place, -1))
            own = last >= array.maximum(start, 0)
            held = ~own & (start < 0)  # what came with the earlier batches still holds
            pool = arrow.concat_arrays([versions, arrow.nulls(1, kind) if version is None else version])
            at = array.where(own, last, len(batch))
            index = arrow.array(at, mask=~(own | held))
            facts = array.flatnonzero(~is_version)
            found = pool.take(index)
            opening = compute.equal(keys, first[0]).to_numpy(zero_copy_only=False)
            open_ = opening & found.is_null().to_numpy(zero_copy_only=False)
            rows = arrow.array(facts)
            yield arrow.RecordBatch.from_arrays([
                batch.column("__fact").take(rows), found.take(rows), arrow.array(open_[facts]), arrow.array(array.full(len(facts), task), arrow.int32()),
                arrow.nulls(len(facts), arrow.string()), arrow.nulls(len(facts), arrow.string())], names=["__fact", "__version", "__open", "__range", "__first", "__last"])
            key, end = keys.slice(len(batch) - 1, 1), len(batch) - 1
            version = versions.slice(int(last[end]), 1) if own[end] else version if held[end] else None
        if key is not None:
            none = arrow.nulls(1, batch.column("__fact").type)
            yield arrow.RecordBatch.from_arrays([none, arrow.nulls(1, kind) if version is None else version, arrow.array([None], arrow.bool_()),
                                                 arrow.array([task], arrow.int32()), first, key], names=["__fact", "__version", "__open", "__range", "__first", "__last"])

    return fill


def as_of_join(facts: DataFrame, versions: DataFrame, ts: str, start: str, columns, by=(), partitions: int | None = None) -> DataFrame:
    """The facts with ``columns`` of the version that is the last one to begin at or before ``ts``; null where there is none.

    With ``by`` only versions with the same values of these columns count, null being a value like others.  Of versions that begin at one time the one
    with the greatest columns holds.  A version without a start never begins, a fact without a time has no version.  ``columns`` may not carry
    the name of a column of the facts.
    """
    key = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    dated = versions.where(F.col(start).isNotNull()).groupBy(key.alias("__key"), F.col(start).alias("__t")).agg(F.max(F.struct(*columns)).alias("__version"))
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    sides = facts.select(key.alias("__key"), F.col(ts).alias("__t"), fact.alias("__fact"), F.lit(None).cast(dated.schema["__version"].dataType).alias("__version"))
    kind = F.lit(None).cast(sides.schema["__fact"].dataType)
    both = dated.select("__key", "__t", kind.alias("__fact"), "__version").unionByName(sides)
    order = ["__key", F.asc_nulls_first("__t"), F.col("__fact").isNotNull(), F.xxhash64("__fact")]
    ranged = (both.repartitionByRange(partitions, *order) if partitions else both.repartitionByRange(*order)).sortWithinPartitions(*order)
    fields = (f"__fact {sides.schema['__fact'].dataType.simpleString()}, __version {dated.schema['__version'].dataType.simpleString()}, __open boolean, "
              "__range int, __first string, __last string")
    filled = stored(ranged.select("__key", "__fact", "__version").mapInArrow(_filler(pc, pa, np), fields), "as-of")
    ends = filled.where(F.col("__last").isNotNull())
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    known = F.when(F.col("__version").isNotNull(), F.struct(F.col("__last").alias("key"), F.col("__version").alias("version")))
    carried = ends.withColumn("__before", F.last(known, ignorenulls=True).over(earlier)).select(
        "__range", F.when(F.col("__before.key") == F.col("__first"), F.col("__before.version")).alias("__carried"))
    rows = filled.where(F.col("__last").isNull()).join(F.broadcast(carried), "__range", "left")
    version = F.when(F.col("__open"), F.col("__carried")).otherwise(F.col("__version"))
    return rows.withColumn("__version", version).select("__fact.*", *[F.col("__version")[c].alias(c) for c in columns])

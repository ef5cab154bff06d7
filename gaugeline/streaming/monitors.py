"""Continuous monitoring with Structured Streaming.

Each monitor is a transformation of a streaming frame plus a sink that survives lost executors: state and
progress live in the checkpoint folder, results in Parquet.  The same code runs with ``availableNow`` (catch
up and stop) or with a processing-time trigger.

A catch-up run reads old files in any order, so it must not drop rows as late: without ``late`` the windowed
means keep every window's state and ``run_updates`` writes the state of all windows.  A live run bounds its
state with ``late``; ``dropped_rows`` tells how many rows came after their window had closed, and
``run_quarantine`` keeps them.
"""

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from gaugeline.sources.tables import exists


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """File stream over one table, a file or a folder of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # a pattern that only the table itself matches: a stream takes a plain path for a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/{name}.parque[t]")


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need an instant; a wall-clock time is read in the session zone."""
    return df.withColumn("event_time", F.col(ts).cast("timestamp"))


def windowed_means(events: DataFrame, metric: str, score: str, size="7 days", slide=None, late=None) -> DataFrame:
    """Mean per metric and tumbling (or sliding) window, with the latest event time seen in it.

    With ``late`` a window closes once the watermark has passed its end, and later rows are dropped; without it
    every row counts, whatever the order of arrival, at the price of one state row per metric and window.
    """
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    rows = events.withWatermark("event_time", late) if late else events
    means = rows.groupBy(w, F.col(metric).alias("metric")).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"), F.max("event_time").alias("latest"))
    return means.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        "metric", "n", "mean", "latest")


def mark_closed(means: DataFrame, late: str) -> DataFrame:
    """Say which windows ended ``late`` or longer before the latest event of all."""
    seen = means.agg(F.max("latest")).scalar()
    return means.withColumn("closed", F.col("window_end") <= seen - F.expr(f"INTERVAL {late}")).drop("latest")


def first_alerts(closed: DataFrame, below: Column) -> DataFrame:
    """The first closed window of each metric that lies below the line."""
    return closed.where(F.col("closed") & below).groupBy("metric").agg(F.min("window_start").alias("first_alert"))


class FirstAlert(StatefulProcessor):
    """State of one metric: the window of its alert, once there is one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.alert = handle.getValueState("alert", StructType([StructField("window_start", TimestampType())]))

    def handleInputRows(self, key, rows, timerValues):
        firsts = [f for f in (part["window_start"].min() for part in rows) if not pd.isna(f)]
        if firsts and not self.alert.exists():
            first = min(firsts)
            self.alert.update((first.to_pydatetime(),))
            yield pd.DataFrame({"metric": [key[0]], "first_alert": [first]})

    def close(self) -> None:
        pass


#: Setting and value that keep the state of custom operators in RocksDB, which spills to disk and is saved in the checkpoint folder.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def alert_states(closed: DataFrame, below: Column) -> DataFrame:
    """A stream of alerts: one row per metric, in the batch that brings its first closed window below the line.

    ``closed`` streams closed windows (metric, window_start, ...) of a metric in order of time, as a watermarked mean does; inside a
    batch any order will do.  The state is one value per metric that has alerted, so the windows are never read again.
    """
    hits = closed.where(below).select("metric", "window_start")
    return hits.groupBy("metric").transformWithStateInPandas(
        FirstAlert(), StructType([closed.schema["metric"], StructField("first_alert", TimestampType())]), "Append", "None")


def run_alert_states(closed: DataFrame, below: Column, out: str, checkpoint: str, trigger=None):
    """``alert_states`` into exactly-once files; a restart goes on from the state and alerts for no metric twice."""
    name, store = STATE_STORE
    before = closed.sparkSession.conf.get(name)
    closed.sparkSession.conf.set(name, store)
    try:  # a query keeps the settings that it started with
        return run_to_files(alert_states(closed, below), out, checkpoint, trigger)
    finally:
        closed.sparkSession.conf.set(name, before)


def running_confusion(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Confusion counts as labels arrive, joined to a static prediction table; store that table first if it is costly."""
    joined = labels.join(predictions, key, "left")
    return joined.groupBy(
        F.col("y_true").cast("string").alias("y_true"),
        F.coalesce(F.col("y_pred").cast("string"), F.lit("∅")).alias("y_pred"),
    ).agg(F.count("*").alias("n"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, trigger=None):
    """Append-mode Parquet sink with exactly-once files."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def _others(frame: DataFrame, out: str, batch_id: int) -> DataFrame | None:
    """What other batches have written, with the columns of ``frame``; a batch that runs again must not see its own rows."""
    spark = frame.sparkSession
    if not exists(spark, out):
        return None
    schema = StructType([*frame.schema.fields, StructField("batch", LongType())])
    return spark.read.schema(schema).parquet(out).where(F.col("batch") != batch_id)


def run_updates(df: DataFrame, out: str, checkpoint: str, keys, trigger=None):
    """Update-mode results.  Each batch merges its changes with the state before and writes the whole state to a
    folder of its own, so a repeated batch overwrites itself and a reader needs the last folder alone."""
    def save(batch, batch_id):
        rows = batch.withColumn("__new", F.lit(batch_id))
        before = _others(batch, out, batch_id)
        if before is not None:
            last = before.agg(F.max("batch")).first()[0]
            if last is not None:
                rows = rows.unionByName(before.where(F.col("batch") == last).drop("batch").withColumn("__new", F.lit(-1)))
        values = [c for c in batch.columns if c not in keys]
        rows.groupBy(*keys).agg(*[F.max_by(c, "__new").alias(c) for c in values]).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (df.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def latest_updates(spark: SparkSession, out: str) -> DataFrame:
    """The state after the last batch of ``run_updates``."""
    rows = spark.read.parquet(out)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0]).drop("batch")


def run_distinct(events: DataFrame, keys, day: str, out: str, checkpoint: str, trigger=None):
    """Write each key combination once, whatever the order of the files.

    A batch is compared with what is already written for its days: the result is stored by batch and day, so only
    those days are read.
    """
    def save(batch, batch_id):
        fresh = batch.select(*keys).distinct()
        before = _others(fresh, out, batch_id)
        if before is not None:
            days = [r[0] for r in fresh.select(day).distinct().collect()]  # the days of one batch
            fresh = fresh.join(before.where(F.col(day).isin(days)).select(*keys), list(keys), "left_anti")
        fresh.write.mode("overwrite").partitionBy(day).parquet(f"{out}/batch={batch_id}")

    return (events.writeStream.outputMode("append").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def distinct_within(events: DataFrame, keys, late="1 day") -> DataFrame:
    """Live runs: keep the first of repeated judgments that arrive within the bound."""
    return events.withWatermark("event_time", late).dropDuplicatesWithinWatermark(list(keys))


def run_first_alerts(means: DataFrame, below: Column, out: str, checkpoint: str, trigger=None):
    """Live runs: write one alert per metric, the first closed window below the line, and never again.

    ``means`` has a watermark.  Its windows close in time order, so the first batch that has an alert for a
    metric has the earliest one.  Alerts are one row per metric: the table that every batch is checked against
    stays tiny.
    """
    def save(batch, batch_id):
        first = batch.where(below).groupBy("metric").agg(F.min("window_start").alias("first_alert"))
        before = _others(first, out, batch_id)
        if before is not None:
            first = first.join(before.select("metric"), "metric", "left_anti")
        first.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (means.writeStream.outputMode("append").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def run_quarantine(events: DataFrame, late: dt.timedelta, out: str, checkpoint: str, trigger=None):
    """Live runs: keep the rows that come more than ``late`` after the latest event of earlier batches.

    They are the rows that a windowed mean with the same bound may drop.  The latest event time is written
    with each batch, so a restart goes on from it.
    """
    def save(batch, batch_id):
        now = batch.agg(F.max("event_time").alias("latest"))
        before = _others(now, f"{out}/seen", batch_id)
        seen = before.agg(F.max("latest")).first()[0] if before is not None else None
        rows = batch.where(F.lit(False)) if seen is None else batch.where(F.col("event_time") < F.lit(seen - late))
        rows.write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        now.write.mode("overwrite").parquet(f"{out}/seen/batch={batch_id}")

    return (events.writeStream.outputMode("append").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def dropped_rows(query) -> int:
    """Rows that a finished or running query has dropped as later than its watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.streaming import monitors as mo


@pytest.fixture
def feed(spark, folder):
    """Events in several files, so that the stream runs several batches."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=6 * i), "m" if i % 2 else "n", 5.0 - i * 0.02) for i in range(120)]
    schema = "id long, ts timestamp_ntz, metric string, score double"
    for part in range(4):
        spark.createDataFrame(rows[part * 30:(part + 1) * 30], schema).coalesce(1).write.parquet(f"{folder}/in{part}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in*"))
    return rows, mo.event_time(stream), spark.read.schema(schema).parquet(f"{folder}/in*")


def test_closed_windows_equal_the_batch(spark, folder, feed):
    rows, stream, batch = feed
    means = mo.windowed_means(stream, "metric", "score", "2 days", late="6 hours")
    mo.run_to_files(means, f"{folder}/out", f"{folder}/ck").awaitTermination()
    got = {(r.window_start, r.metric): (r.n, round(r["mean"], 9)) for r in spark.read.parquet(f"{folder}/out").collect()}
    want = {(r.w, r.metric): (r.n, round(r.m, 9)) for r in batch.groupBy(
        F.window(F.col("ts").cast("timestamp"), "2 days").start.alias("w"), "metric").agg(F.count("*").alias("n"), F.avg("score").alias("m")).collect()}
    last = max(r[1] for r in rows) - dt.timedelta(hours=6)
    closed = {k: v for k, v in want.items() if k[0] + dt.timedelta(days=2) <= last}
    assert got == closed and len(closed) > 10


def test_sliding_windows(spark, folder, feed):
    _, stream, _ = feed
    means = mo.windowed_means(stream, "metric", "score", "2 days", "1 day", late="6 hours")
    mo.run_to_files(means, f"{folder}/out", f"{folder}/ck").awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    assert out.select("window_start").distinct().count() > 20
    assert out.groupBy("window_start", "metric").count().where("count > 1").count() == 0


def test_first_alert_is_written_once(spark, folder, feed):
    _, stream, _ = feed
    means = mo.windowed_means(stream, "metric", "score", "2 days", late="6 hours")
    mo.run_first_alerts(means, F.col("mean") < 4.5, f"{folder}/out", f"{folder}/ck").awaitTermination()
    alerts = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r.metric for r in alerts) == ["m", "n"]
    mo.run_to_files(means, f"{folder}/w", f"{folder}/ck2").awaitTermination()
    first = {r.metric: r.f for r in spark.read.parquet(f"{folder}/w").where("mean < 4.5").groupBy("metric").agg(F.min("window_start").alias("f")).collect()}
    assert {r.metric: r.first_alert for r in alerts} == first


def test_restart_goes_on_where_it_stopped(spark, folder, feed):
    _, stream, batch = feed
    once = mo.distinct_within(stream, ["id"], "1 day").select("id")
    for _ in range(2):
        mo.run_to_files(once, f"{folder}/out", f"{folder}/ck").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == sorted(r.id for r in batch.collect())


def test_repeats_are_dropped(spark, folder, feed):
    _, stream, _ = feed
    rows = stream.withColumn("item", F.floor(F.col("id") / 4))
    mo.run_to_files(mo.distinct_within(rows, ["item", "metric"], "2 days").select("item", "metric"), f"{folder}/out", f"{folder}/ck").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 60


def test_running_confusion_ends_at_the_batch_result(spark, folder, feed):
    _, stream, batch = feed
    truth = (F.col("id") % 3 == 0).cast("int").alias("y_true")
    preds = batch.where("id < 100").select("id", (F.col("id") % 2).alias("y_pred"))
    counts = mo.running_confusion(stream.select("id", truth), preds, "id")
    mo.run_updates(counts, f"{folder}/out", f"{folder}/ck", ["y_true", "y_pred"]).awaitTermination()
    got = {(r.y_true, r.y_pred): r.n for r in mo.latest_updates(spark, f"{folder}/out").collect()}
    want = {}
    for i in range(120):
        k = (str(int(i % 3 == 0)), str(i % 2) if i < 100 else "∅")
        want[k] = want.get(k, 0) + 1
    assert got == want


def test_late_rows_count_only_within_the_bound(spark, folder):
    schema = "id long, ts timestamp_ntz, metric string, score double"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    files = [
        [(1, day(1), "m", 1.0), (2, day(3, 12), "m", 1.0)],
        [(3, day(2, 20), "m", 5.0)],  # late, but its window is still open
        [(4, day(20), "m", 1.0)],     # moves the watermark far ahead
        [(5, day(2), "m", 5.0), (6, day(28), "m", 1.0)],  # too late: the window is closed
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in{i}")
    means, n = None, 0
    for i in range(len(files)):  # one run per arriving file, same checkpoint
        stream = mo.event_time(spark.readStream.schema(schema).parquet(f"{folder}/in[0-{i}]"))
        means = mo.windowed_means(stream, "metric", "score", "1 day", late="1 day")
        mo.run_to_files(means, f"{folder}/out", f"{folder}/ck").awaitTermination()
    got = {r.window_start.day: (r.n, r["mean"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got[1] == (1, 1.0) and got[2] == (1, 5.0) and got[3] == (1, 1.0) and got[20] == (1, 1.0)
    assert set(got) == {1, 2, 3, 20}


@pytest.fixture
def shuffled_table(spark, folder, monkeypatch):
    """The given events and labels as folders of four files in no order of time, read one file a batch."""
    source = "/root/testdata/sf0.001"
    for name, key in (("events", "event_id"), ("labels", "doc_id")):
        spark.read.parquet(f"{source}/{name}.parquet").repartition(4, F.xxhash64(key)).write.parquet(f"{folder}/{name}.parquet")
    spark.read.parquet(f"{source}/documents.parquet").write.parquet(f"{folder}/documents.parquet")
    whole = mo.stream_table
    monkeypatch.setattr(mo, "stream_table", lambda s, d, n: whole(s, d, n, files_per_batch=1))
    return folder


@pytest.mark.parametrize("name", ["stream_drift", "stream_first_alert", "stream_alert_state", "stream_confusion", "stream_dedup"])
def test_unordered_files_of_a_table_folder_equal_the_batch(spark, shuffled_table, name):
    import check

    con = check.oracle("/root/testdata/sf0.001")
    assert len(spark.read.parquet(f"{shuffled_table}/events.parquet").inputFiles()) == 4
    status, note = check.compare(spark, con, name, shuffled_table)
    assert status == "ok", note


def test_a_repeated_batch_changes_nothing(spark, folder, feed):
    _, stream, batch = feed
    rows = stream.withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    for ck in ("ck", "ck"):
        mo.run_distinct(rows, ["metric", "day"], "day", f"{folder}/out", f"{folder}/{ck}").awaitTermination()
    mo.run_distinct(rows, ["metric", "day"], "day", f"{folder}/out", f"{folder}/lost-progress").awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == out.select("metric", "day").distinct().count() == 60


def test_late_rows_of_a_live_run_are_counted_and_kept(spark, folder):
    schema = "id long, ts timestamp_ntz, metric string, score double"
    day = lambda d: dt.datetime(2024, 1, d)
    for i, rows in enumerate([[(1, day(1), "m", 1.0)], [(2, day(20), "m", 1.0)], [(3, day(21), "m", 2.0)], [(4, day(2), "m", 9.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in{i}")
        stream = mo.event_time(spark.readStream.schema(schema).parquet(f"{folder}/in[0-{i}]"))
        means = mo.windowed_means(stream, "metric", "score", "1 day", late="1 day")
        query = mo.run_to_files(means, f"{folder}/out", f"{folder}/ck")
        query.awaitTermination()
        mo.run_quarantine(stream, dt.timedelta(days=1), f"{folder}/q", f"{folder}/ckq").awaitTermination()
    assert mo.dropped_rows(query) == 1
    assert [r.id for r in spark.read.parquet(f"{folder}/q/late").collect()] == [4]


def test_alert_state_alerts_once_over_restarts_and_equals_the_batch(spark, folder):
    day = lambda d: dt.datetime(2024, 1, d)
    runs = [
        [("a", day(2), 1.0), ("a", day(1), 3.0), ("b", day(1), 3.0), ("hot", day(1), 1.5), ("hot", day(2), 1.0)],
        [("a", day(3), 0.5), ("b", day(2), 3.0), ("c", day(1), 2.0), (None, day(3), 1.0)],
        [("b", day(4), 1.0), ("b", day(3), 1.9), ("c", day(2), 2.0), ("a", day(9), 1.0), (None, day(5), 1.0)],
        [("b", day(5), 0.0), ("hot", day(6), 0.0)],
    ]
    every, alerts_by_run = [], []
    for i, rows in enumerate(runs):  # a new query on the same checkpoint is a restart
        every += rows
        spark.createDataFrame(rows, "metric string, window_start timestamp, mean double").coalesce(1).write.parquet(f"{folder}/in{i}")
        closed = spark.readStream.schema("metric string, window_start timestamp, mean double").parquet(f"{folder}/in[0-{i}]")
        mo.run_alert_states(closed, F.col("mean") < 2, f"{folder}/out", f"{folder}/ck").awaitTermination()
        out = spark.read.schema("metric string, first_alert timestamp").parquet(f"{folder}/out").collect()
        alerts_by_run.append(len(out))
    first = {}
    for metric, at, mean in every:
        if mean < 2:
            first[metric] = min(first.get(metric, at), at)
    assert {r.metric: r.first_alert for r in out} == first and len(out) == len(first) == 4
    assert alerts_by_run == [2, 3, 4, 4]
    assert "RocksDB" not in spark.conf.get(mo.STATE_STORE[0])

"""The monitors run as streams over the table files until they have caught up."""

from pyspark.sql import functions as F

from gaugeline.functions.scores import half_step_score
from gaugeline.plans.registry import query
from gaugeline.plans.views import QUALITY_EVAL, SCORES, quality_eval, with_views
from gaugeline.sources.tables import scratch, stored
from gaugeline.streaming import monitors as mo

# Windows of 7 days start on Thursdays, like day 0 of the Unix epoch.
WINDOWS = """
wd AS (SELECT metric, score, floor(epoch(ts) / 604800) * 604800 AS w FROM v_scores),
wm AS (SELECT metric, w, count(*) AS n, avg(score) AS mean,
    w + 604800 <= (SELECT epoch(max(ts)) - 86400 FROM v_scores) AS closed FROM wd GROUP BY ALL)"""
_START = "strftime(make_timestamp((w * 1000000)::BIGINT), '%Y-%m-%d')"


def score_stream(spark, d):
    events = mo.event_time(mo.stream_table(spark, d, "events"))
    return events.select("event_time", "event_id", "user_id", F.col("event_type").alias("metric"),
                         half_step_score(F.col("value")).alias("score"))


def _date(c):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def weekly_means(spark, d, label):
    """All windows after catching up, the ones still open included."""
    out = scratch(spark, label)
    means = mo.windowed_means(score_stream(spark, d), "metric", "score")
    mo.run_updates(means, f"{out}/data", f"{out}/checkpoint", ["window_start", "window_end", "metric"]).awaitTermination()
    return mo.mark_closed(mo.latest_updates(spark, f"{out}/data"), "1 DAY")


@query(with_views(SCORES, WINDOWS) + f"SELECT {_START} AS window_start, metric, n, round(mean, 6) AS mean, closed FROM wm")
def stream_drift(spark, d):
    """Weekly means per metric, with the windows that can no longer change marked closed."""
    return weekly_means(spark, d, "drift").select(_date("window_start"), "metric", "n", "mean", "closed")


@query(with_views(SCORES, WINDOWS) + f"""
SELECT metric, {_START.replace('(w ', '(min(w) ')} AS first_alert FROM wm WHERE closed AND mean < 1 + 95e-2 GROUP BY metric""")
def stream_first_alert(spark, d):
    return mo.first_alerts(weekly_means(spark, d, "alert"), F.col("mean") < 1.95).select("metric", _date("first_alert"))


@query(with_views(SCORES, WINDOWS) + f"""
SELECT metric, {_START.replace('(w ', '(min(w) ')} AS first_alert FROM wm WHERE closed AND mean < 1 + 95e-2 GROUP BY metric""")
def stream_alert_state(spark, d):
    """First alerts from keyed state: the windows that a catch-up run has closed are streamed on into one state per metric."""
    out = scratch(spark, "alert-state")
    means = weekly_means(spark, d, "closed").where("closed").select("window_start", "metric", "mean")
    means.write.parquet(f"{out}/closed")
    closed = spark.readStream.schema(means.schema).parquet(f"{out}/closed")
    mo.run_alert_states(closed, F.col("mean") < 1.95, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    alerts = spark.read.schema("metric string, first_alert timestamp").parquet(f"{out}/data")
    return alerts.select("metric", _date("first_alert"))


@query(with_views(QUALITY_EVAL) + """
SELECT y_true::VARCHAR AS y_true, pred_A::VARCHAR AS y_pred, count(*) AS n FROM v_quality_eval GROUP BY ALL""")
def stream_confusion(spark, d):
    """Confusion counts kept up to date while labels arrive; the predictions are stored once for all batches."""
    out = scratch(spark, "confusion")
    labels = mo.stream_table(spark, d, "labels").select("doc_id", F.col("quality").alias("y_true"))
    preds = stored(quality_eval(spark, d).select("doc_id", F.col("pred_A").alias("y_pred")), "predictions")
    counts = mo.running_confusion(labels, preds, "doc_id")
    mo.run_updates(counts, f"{out}/data", f"{out}/checkpoint", ["y_true", "y_pred"]).awaitTermination()
    return mo.latest_updates(spark, f"{out}/data")


@query("SELECT DISTINCT user_id, event_type AS metric, strftime(ts, '%Y-%m-%d') AS day FROM events")
def stream_dedup(spark, d):
    """Repeated judgments of one item, judge and day count once, whatever the order of the files."""
    out = scratch(spark, "dedup")
    rows = score_stream(spark, d).withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    mo.run_distinct(rows, ["user_id", "metric", "day"], "day", f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("user_id", "metric", F.date_format("day", "yyyy-MM-dd").alias("day"))

"""Drift, alerts and version changes on the event stream, in batch."""

from pyspark.sql import functions as F

from gaugeline.operators import drift as dr
from gaugeline.operators.asof import as_of_join
from gaugeline.plans.registry import query
from gaugeline.plans.views import SCORES, scores, with_views

# The model versions that were live during the month, with their start times.
VERSIONS = [("2024-01-01 00:00:00", "v1"), ("2024-01-08 12:00:00", "v2"), ("2024-01-15 00:00:00", "v3"),
            ("2024-01-23 06:30:00", "v4")]
THRESHOLD = 1.95

SERIES = """
sr AS (SELECT metric, date_trunc('week', day)::DATE AS period, count(*) AS n, avg(score) AS mean FROM v_scores GROUP BY ALL),
sx AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY period) - 1 AS idx,
    mean - lag(mean) OVER (PARTITION BY metric ORDER BY period) AS change FROM sr)"""
DAILY = SERIES.replace("date_trunc('week', day)::DATE", "day")


def weekly(spark, d):
    return dr.series(scores(spark, d), "ts", "metric", "score", "week")


def daily(spark, d):
    return dr.series(scores(spark, d), "ts", "metric", "score", "day")


@query(with_views(SCORES, SERIES) + f"""
SELECT metric, count(*) AS periods, round(arg_min(mean, period), 6) AS first, round(arg_max(mean, period), 6) AS last,
  round(arg_min(mean, period) - arg_max(mean, period), 6) AS total_drop,
  coalesce(min(period) FILTER (mean < 1 + 95e-2)::VARCHAR, 'Never') AS first_alert FROM sx GROUP BY 1""")
def drift_summary(spark, d):
    return dr.drift_summary(weekly(spark, d), THRESHOLD)


@query(with_views(SCORES, SERIES) + """
SELECT metric, period::VARCHAR AS period, n, round(mean, 6) AS mean, round(change, 6) AS change FROM sx""")
def period_change(spark, d):
    return dr.changes(weekly(spark, d)).select("metric", F.col("period").cast("string").alias("period"), "n", "mean", "change")


@query(with_views(SCORES, SERIES, """
sh AS (SELECT metric, max(-change) AS dropped, arg_min(period, change) AS dp, regr_slope(mean, idx) AS slope,
    max(mean) - min(mean) AS rng FROM sx GROUP BY 1)""") + """
SELECT metric, round(dropped, 6) AS largest_drop, dp::VARCHAR AS drop_period, round(slope, 6) AS slope, round(rng, 6) AS range,
  CASE WHEN dropped > 5e-1 * rng THEN 'shock' ELSE 'gradual' END AS kind FROM sh""")
def drift_shock(spark, d):
    return dr.shock(weekly(spark, d))


@query(with_views(SCORES, DAILY, """
al AS (SELECT metric, min(idx) FILTER (mean < 1 + 95e-2) AS a, min(idx) FILTER (mean < 1 + 95e-2 AND idx % 3 = 0) AS a3,
    min(idx) FILTER (mean < 1 + 95e-2 AND idx % 7 = 0) AS a7 FROM sx GROUP BY 1)""") + """
SELECT metric, a AS alert, a3 AS alert_every_3, a7 AS alert_every_7, a3 - a AS delay_every_3, a7 - a AS delay_every_7 FROM al""")
def detection_delay(spark, d):
    return dr.detection_delay(daily(spark, d), THRESHOLD, [3, 7])


_VERSIONS = ", ".join(f"(TIMESTAMP '{t}', '{v}')" for t, v in VERSIONS)
AS_OF = f"""
vt AS (SELECT * FROM (VALUES {_VERSIONS}) x(start, version)),
v_ver AS (SELECT s.*, vt.version FROM v_scores s ASOF JOIN vt ON s.ts >= vt.start)"""


def versioned(spark, d):
    return scores(spark, d).withColumn("version", dr.version_at(F.col("ts"), VERSIONS))


@query(with_views(SCORES, AS_OF) + """
SELECT version, metric, count(*) AS n, round(avg(score), 6) AS mean FROM v_ver GROUP BY ALL""")
def score_by_version(spark, d):
    return versioned(spark, d).groupBy("version", "metric").agg(F.count("*").alias("n"), F.avg("score").alias("mean"))


@query(with_views(SCORES, """
rl AS (SELECT start, 'r' || row_number() OVER (ORDER BY start) AS release FROM
    (SELECT min(ts) AS start FROM v_scores GROUP BY day)),
a AS (SELECT s.event_id, s.score, rl.release FROM v_scores s ASOF JOIN rl ON s.ts >= rl.start)""") + """
SELECT release, count(*) AS n, round(avg(score), 6) AS mean FROM a GROUP BY 1""")
def score_by_release(spark, d):
    """As-of join to a release table taken from the data: one release per day."""
    s = scores(spark, d)
    starts = s.groupBy("day").agg(F.min("ts").alias("start"))
    releases = starts.select("start", F.concat(F.lit("r"), (F.datediff("day", starts.agg(F.min("day")).scalar()) + 1)
                                               .cast("string")).alias("release"))
    joined = dr.as_of_versions(s.select("event_id", "ts", "score"), releases, "ts", "start", "release")
    return joined.where("release IS NOT NULL").groupBy("release").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean"))


@query(with_views(SCORES, """
pv AS (SELECT user_id, ts AS changed, max(event_id) AS change_id FROM v_scores WHERE score >= 2 GROUP BY ALL),
a AS (SELECT s.event_id, s.metric, s.score, s.ts, pv.changed, pv.change_id FROM v_scores s ASOF LEFT JOIN pv ON s.user_id = pv.user_id AND s.ts >= pv.changed)""") + """
SELECT metric, count(*) AS n, count(change_id) AS with_change, sum(change_id)::BIGINT AS change_ids, round(avg(epoch(ts) - epoch(changed)), 3) AS mean_age FROM a GROUP BY 1""")
def score_since_change(spark, d):
    """As-of join within every user: each score with the user's last one of 2 or more."""
    s = scores(spark, d)
    changes = s.where("score >= 2").select("user_id", F.col("ts").alias("changed"), F.col("event_id").alias("change_id"))
    joined = as_of_join(s.select("event_id", "user_id", "metric", "ts"), changes.withColumn("began", F.col("changed")), "ts", "began", ["change_id", "changed"], ["user_id"])
    age = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("changed").cast("timestamp"))) / 1e6
    return joined.groupBy("metric").agg(F.count("*").alias("n"), F.count("change_id").alias("with_change"), F.sum("change_id").alias("change_ids"),
                                        F.round(F.avg(age), 3).alias("mean_age"))


@query(with_views(SCORES, AS_OF, """
vm AS (SELECT metric, version, count(*) AS n, avg(score) AS mean, stddev_samp(score) / sqrt(count(*)) AS se FROM v_ver GROUP BY ALL),
vc AS (SELECT *, mean - lag(mean) OVER w AS delta, sqrt(se * se + pow(lag(se) OVER w, 2)) AS delta_se FROM vm
  WINDOW w AS (PARTITION BY metric ORDER BY version))""") + """
SELECT metric, version, n, round(mean, 6) AS mean, round(se, 6) AS se, round(delta, 6) AS delta, round(delta_se, 6) AS delta_se,
  coalesce(delta < -2 * delta_se, false) AS regression FROM vc""")
def version_change(spark, d):
    means = versioned(spark, d).groupBy("metric", "version").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean"),
        (F.stddev_samp("score") / F.sqrt(F.count("*"))).alias("se"))
    return dr.version_change(means, "version")


@query(with_views(SCORES, """
le AS (SELECT user_id AS system, max(ts) AS last_eval FROM v_scores GROUP BY 1),
ag AS (SELECT *, DATE '2024-01-31' - last_eval::DATE AS age FROM le)""") + """
SELECT system, last_eval::DATE::VARCHAR AS last_eval, age::INT AS age_days, age > 3 AS too_old,
  last_eval < TIMESTAMP '2024-01-23 06:30:00' AS version_changed, age > 3 OR last_eval < TIMESTAMP '2024-01-23 06:30:00' AS due FROM ag""")
def rebaseline_due(spark, d):
    """Every user stands for one monitored system."""
    change = F.lit(VERSIONS[-1][0]).cast("timestamp_ntz")
    return dr.rebaseline_due(scores(spark, d), "user_id", "ts", F.lit("2024-01-31").cast("date"), 3, change)

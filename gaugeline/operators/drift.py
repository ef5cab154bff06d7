"""Scores over time: alerts, shocks, detection delay, versions."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.operators.asof import as_of_join


def series(df: DataFrame, ts: str, metric: str, score: str, unit: str = "week") -> DataFrame:
    """Mean score per metric and period, with the 0-based period index."""
    day = F.col(ts).cast("date")
    period = day if unit == "day" else F.trunc(day, unit).cast("date")
    means = df.groupBy(F.col(metric).alias("metric"), period.alias("period")).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"))
    order = Window.partitionBy("metric").orderBy("period")
    return means.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))


def drift_summary(s: DataFrame, threshold: float) -> DataFrame:
    """First and last mean, total drop and first period strictly below the line."""
    return s.groupBy("metric").agg(
        F.count("*").alias("periods"),
        F.min_by("mean", "period").alias("first"), F.max_by("mean", "period").alias("last"),
        (F.min_by("mean", "period") - F.max_by("mean", "period")).alias("total_drop"),
        F.coalesce(F.min(F.when(F.col("mean") < threshold, F.col("period"))).cast("string"),
                   F.lit("Never")).alias("first_alert"))


def changes(s: DataFrame) -> DataFrame:
    prev = F.lag("mean").over(Window.partitionBy("metric").orderBy("period"))
    return s.withColumn("change", F.col("mean") - prev)


def shock(s: DataFrame, share: float = 0.5) -> DataFrame:
    """Largest single-period drop, trend slope, and which of the two it looks like."""
    c = changes(s)
    out = c.groupBy("metric").agg(
        F.max(-F.col("change")).alias("largest_drop"),
        F.min_by("period", F.when(F.col("change").isNotNull(), F.struct("change", "period"))).cast("string").alias("drop_period"),
        F.regr_slope("mean", "idx").alias("slope"),
        (F.max("mean") - F.min("mean")).alias("range"))
    sudden = F.col("largest_drop") > share * F.col("range")
    return out.withColumn("kind", F.when(sudden, "shock").otherwise("gradual"))


def detection_delay(s: DataFrame, threshold: float, every) -> DataFrame:
    """Periods lost when only every k-th period is checked."""
    below = F.col("mean") < threshold
    firsts = [F.min(F.when(below & (F.col("idx") % k == 0), F.col("idx"))).alias(f"alert_every_{k}") for k in every]
    out = s.groupBy("metric").agg(F.min(F.when(below, F.col("idx"))).alias("alert"), *firsts)
    return out.select("*", *[(F.col(f"alert_every_{k}") - F.col("alert")).alias(f"delay_every_{k}") for k in every])


def version_at(ts: Column, timeline) -> Column:
    """Name of the version live at a time, from a short literal timeline.

    ``timeline`` is (start, name) in order of start; no join is needed, and the
    list is part of the query text, so it cannot grow with the data.
    """
    out = F.lit(None).cast("string")
    for start, name in timeline:
        out = F.when(ts >= F.lit(start).cast("timestamp_ntz"), name).otherwise(out)
    return out


def as_of_versions(facts: DataFrame, versions: DataFrame, ts: str, start: str, name: str) -> DataFrame:
    """The facts with the name of the version that was live at their time, null before the first one."""
    return as_of_join(facts, versions, ts, start, [name])


def version_change(means: DataFrame, version_order: str) -> DataFrame:
    """Score change at each version boundary against a noise band of 2 se."""
    w = Window.partitionBy("metric").orderBy(version_order)
    delta = F.col("mean") - F.lag("mean").over(w)
    se = F.sqrt(F.pow("se", F.lit(2)) + F.pow(F.lag("se").over(w), F.lit(2)))
    return means.withColumns({"delta": delta, "delta_se": se}).withColumn(
        "regression", F.coalesce(F.col("delta") < -2 * F.col("delta_se"), F.lit(False)))


def rebaseline_due(df: DataFrame, system: str, ts: str, now: Column, max_age_days: int, last_change: Column):
    """Systems whose last evaluation is too old, or older than the last version."""
    last = df.groupBy(F.col(system).alias("system")).agg(F.max(ts).alias("last_eval"))
    age = F.datediff(now, F.col("last_eval"))
    return last.select(
        "system", F.col("last_eval").cast("date").cast("string").alias("last_eval"), age.alias("age_days"),
        (age > max_age_days).alias("too_old"), (F.col("last_eval") < last_change).alias("version_changed"),
        ((age > max_age_days) | (F.col("last_eval") < last_change)).alias("due"))

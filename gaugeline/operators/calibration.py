"""Confidence against correctness: reliability, rescaling, routing."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.functions.frames import with_grid


def reliability(df: DataFrame, conf: str, correct: str, bins: int = 10) -> DataFrame:
    bin_ = F.least(F.floor(F.col(conf) * bins), F.lit(bins - 1)).cast("int")
    return df.where(F.col(conf).isNotNull()).groupBy(bin_.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(conf).alias("mean_conf"),
        F.avg(F.col(correct).cast("double")).alias("accuracy"))


def calibration_error(table: DataFrame) -> DataFrame:
    """Expected calibration error from a reliability table."""
    gap = F.abs(F.col("mean_conf") - F.col("accuracy"))
    return table.agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"),
        (F.sum(F.col("n") * F.col("accuracy")) / F.sum("n")).alias("accuracy"),
        F.max(gap).alias("max_gap"))


def temperature_losses(hist: DataFrame, conf: str, correct: str, weight: str, temperatures) -> DataFrame:
    """Log loss of the rescaled confidence per temperature.

    ``hist`` holds one row per distinct (confidence, correct) with its count, so
    the grid multiplies distinct values, not rows.
    """
    p = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col(conf)))
    grid = with_grid(hist.withColumn("__z", F.ln(p / (1 - p))), "temperature", temperatures)
    q = 1.0 / (1.0 + F.exp(-F.col("__z") / F.col("temperature")))
    loss = -F.when(F.col(correct) == 1, F.ln(q)).otherwise(F.ln(1 - q))
    return grid.groupBy("temperature").agg(
        (F.sum(F.col(weight) * loss) / F.sum(weight)).alias("log_loss"))


def mark_best(losses: DataFrame) -> DataFrame:
    best = F.min_by("temperature", F.struct("log_loss", "temperature")).over(Window.partitionBy())
    return losses.withColumn("best", F.col("temperature") == best)


def routing(hist: DataFrame, conf: str, right: str, weight: str, cuts) -> DataFrame:
    """Coverage and accuracy when only answers at or above a cut are kept; ``hist`` as for ``temperature_losses``."""
    rows = with_grid(hist, "cut", cuts)
    keep: Column = F.coalesce(F.col(conf) >= F.col("cut"), F.lit(False))
    kept = F.sum(F.when(keep, F.col(weight)).otherwise(0))
    hits = F.sum(F.when(keep, F.col(right) * F.col(weight)).otherwise(0))
    total = F.sum(weight)
    return rows.groupBy("cut").agg(
        kept.alias("kept"), (total - kept).alias("to_humans"), (kept / total).alias("coverage"),
        (hits / F.nullif(kept, F.lit(0))).alias("accuracy"))

"""Scorecards, corpus statistics, ship decision, report completeness."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.functions.scores import nearest_half

# Scorecard weights and the ship rule.
SCORECARD_WEIGHTS = {"accuracy": 0.45, "completeness": 0.45, "fluency": 0.10}
MIN_GAIN, MIN_AGREEMENT = 0.04, 0.80


def overall(columns: dict | None = None, weights=None) -> Column:
    """Weighted overall, nearest half point, kept in [1, 5]."""
    weights = weights or SCORECARD_WEIGHTS
    columns = columns or {k: F.col(k) for k in weights}
    raw = None
    for k, w in weights.items():
        part = F.lit(w) * columns[k]
        raw = part if raw is None else raw + part
    return nearest_half(raw)


def means(df: DataFrame, columns) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])


def size_stats(df: DataFrame, size: str, by=()) -> DataFrame:
    """min, upper median and max; the median is read from a value histogram."""
    hist = df.groupBy(*by, size).agg(F.count("*").alias("__w"))
    w = Window.partitionBy(*by)
    hist = hist.withColumns({
        "__cum": F.sum("__w").over(w.orderBy(size).rowsBetween(Window.unboundedPreceding, 0)),
        "__n": F.sum("__w").over(w)})
    return hist.groupBy(*by).agg(
        F.sum("__w").alias("n"), F.min(size).alias("min"),
        F.min(F.when(F.col("__cum") > F.floor(F.col("__n") / 2), F.col(size))).alias("median"),
        F.max(size).alias("max"))


def ship_criteria(delta: Column, lo: Column, hi: Column, guardrail: Column, tolerance: float,
                  worst_segment: Column, segment_tolerance: float, agreement: Column) -> Column:
    """One struct per criterion: name, value, passed."""
    def row(name, value, passed):
        return F.struct(F.lit(name).alias("criterion"), value.cast("double").alias("value"),
                        F.coalesce(passed, F.lit(False)).alias("passed"))
    return F.array(
        row("gain", delta, delta >= MIN_GAIN),
        row("range_excludes_0", lo, lo > 0),
        row("guardrail", guardrail, guardrail <= tolerance),
        row("worst_segment", worst_segment, worst_segment >= -segment_tolerance),
        row("judge_agreement", agreement, agreement >= MIN_AGREEMENT),
    )


def ship_verdict(criteria: Column, lo: Column, hi: Column) -> Column:
    """ship / canary / no ship / inconclusive."""
    def passed(*names):
        return F.forall(F.filter(criteria, lambda c: c["criterion"].isin(*names)), lambda c: c["passed"])
    return (
        F.when(~passed("judge_agreement"), "inconclusive")
        .when(hi < 0, "no ship")
        .when(~passed("guardrail", "worst_segment"), "no ship")
        .when(passed("gain", "range_excludes_0"), "ship")
        .when(lo <= 0, "inconclusive")
        .otherwise("canary"))


REPORT_FIELDS = ("n", "range_lo", "range_hi", "breakdown", "guardrail", "calibration", "rebaseline")


def report_flags(df: DataFrame, keys, fields=REPORT_FIELDS) -> DataFrame:
    """Names of the required fields a submitted report leaves empty."""
    flags = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    out = df.select(*keys, flags.alias("__flags"))
    return out.select(
        *keys, F.array_join("__flags", ",").alias("missing"), F.size("__flags").alias("n_missing"),
        (F.size("__flags") == 0).alias("complete"))

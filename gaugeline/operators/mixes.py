"""Segment mixes: reweighting, bias gap, representativeness, spread."""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Gap bands and the weak-segment line.
GAP_BAND, WEAK_LINE = 0.15, 3.5


def mix(df: DataFrame, segment: str) -> DataFrame:
    counts = df.groupBy(F.col(segment).alias("segment")).agg(F.count("*").alias("weight"))
    return counts.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy()))


def segment_means(df: DataFrame, segment: str, metrics: dict) -> DataFrame:
    """Long table (segment, metric, mean) from one pass; ``metrics`` maps name to Column."""
    names = list(metrics)
    wide = df.groupBy(F.col(segment).alias("segment")).agg(*[F.avg(metrics[m]).alias(m) for m in names])
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean")) for m in names])
    return wide.select("segment", F.explode(pairs).alias("__x")).select("segment", "__x.*")


def reweight(means: DataFrame, weights: DataFrame) -> DataFrame:
    """Metric means under a target mix; weights are normalised by their total.

    A segment of the mix without rows in the test is left out and its share is
    reported in ``missing_share``.
    """
    rows = weights.select("segment", "weight").join(means, "segment", "left")
    total = weights.agg(F.sum("weight")).scalar()
    have = rows.where("mean IS NOT NULL")
    return have.groupBy("metric").agg(
        (F.sum(F.col("weight") * F.col("mean")) / F.sum("weight")).alias("reweighted"),
        F.sum("weight").alias("__have"),
    ).withColumn("missing_share", 1 - F.col("__have") / total).drop("__have")


def gap_band(gap: Column) -> Column:
    return F.when(gap > GAP_BAND, "test flatters").when(gap < -GAP_BAND, "test understates").otherwise("close")


def bias_gap(means: DataFrame, test_mix: DataFrame, production_mix: DataFrame) -> DataFrame:
    test = reweight(means, test_mix).select("metric", F.col("reweighted").alias("test_says"))
    live = reweight(means, production_mix).select("metric", F.col("reweighted").alias("production"))
    out = test.join(live, "metric").withColumn("gap", F.col("test_says") - F.col("production"))
    return out.withColumn("band", gap_band(F.col("gap")))


def compare_mixes(test_mix: DataFrame, production_mix: DataFrame) -> DataFrame:
    t = test_mix.select("segment", F.col("share").alias("test_share"))
    p = production_mix.select("segment", F.col("share").alias("production_share"))
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("test_share", "production_share")}
    out = t.join(p, "segment", "full_outer").withColumns(zero)
    return out.withColumns({
        "ratio": F.col("test_share") / F.nullif(F.col("production_share"), F.lit(0.0)),
        "total_test": F.sum("test_share").over(Window.partitionBy()),
    })


def breakdown(df: DataFrame, segment: str, metrics: dict, line: float = WEAK_LINE) -> DataFrame:
    """Headline and per-segment means in one table, with a weak-segment flag.

    The headline is summed up from the segment sums, so rows are read once and
    not repeated per grouping set.
    """
    names = list(metrics)
    sums = df.groupBy(F.col(segment).alias("segment")).agg(
        F.count("*").alias("n"),
        *[F.sum(metrics[m]).alias(f"{m}__s") for m in names],
        *[F.count(metrics[m]).alias(f"{m}__c") for m in names])
    rolled = sums.groupingSets([[], ["segment"]], "segment").agg(
        F.grouping("segment").cast("int").alias("is_total"), F.sum("n").alias("n"),
        *[(F.sum(f"{m}__s") / F.nullif(F.sum(f"{m}__c"), F.lit(0))).alias(m) for m in names])
    weak = F.least(*[F.col(m) for m in names]) if len(names) > 1 else F.col(names[0])
    label = F.when(F.col("is_total") == 1, "(all)").otherwise(F.col("segment"))
    return rolled.select(label.alias("segment"), "n", *names, (weak < line).alias("weak"))


def domain_variance(df: DataFrame, segment: str, score: Column) -> DataFrame:
    """Spread between segment means against the spread inside segments."""
    per = df.groupBy(F.col(segment).alias("segment")).agg(
        F.count(score).alias("n"), F.avg(score).alias("m"), F.var_pop(score).alias("v"))
    return per.agg(
        F.count("*").alias("segments"), F.stddev_pop("m").alias("between_std"),
        F.sqrt(F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("within_std"),
        F.min_by("segment", F.struct("m", "segment")).alias("weakest"), F.min("m").alias("weakest_mean"),
        F.max_by("segment", F.struct("m", "segment")).alias("strongest"), F.max("m").alias("strongest_mean"))

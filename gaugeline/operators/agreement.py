"""Agreement of raters and judges, and audits of a judge."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions.scores import kappa
from gaugeline.operators.selection import quantiles
from gaugeline.sources.tables import stored


def agreement_pairs(df: DataFrame, raters: dict, by=()) -> DataFrame:
    """Agreement and kappa for every pair of raters (columns) per slice.

    The pairs of one item are built inside its row, so nothing is joined and
    only (pairs x slices) partial sums are shuffled.
    """
    names = sorted(raters)
    pairs = [
        F.struct(F.lit(x).alias("rater_1"), F.lit(y).alias("rater_2"),
                 raters[x].cast("int").alias("__a"), raters[y].cast("int").alias("__b"))
        for x, y in combinations(names, 2)
    ]
    rows = df.select(*by, F.explode(F.array(*pairs)).alias("__p")).select(*by, "__p.*")
    rows = rows.where("__a IS NOT NULL AND __b IS NOT NULL")
    sums = rows.groupBy("rater_1", "rater_2", *by).agg(
        F.count("*").alias("n"),
        F.avg((F.col("__a") == F.col("__b")).cast("double")).alias("agreement"),
        F.avg((F.col("__a") == 1).cast("double")).alias("__pa"),
        F.avg((F.col("__b") == 1).cast("double")).alias("__pb"),
    )
    return sums.withColumn("kappa", kappa(F.col("agreement"), F.col("__pa"), F.col("__pb"))).drop("__pa", "__pb")


def pooled(votes: Column) -> dict:
    """Mean vote, majority (ties up) and whether the raters disagree; ``votes`` is an array."""
    known = F.filter(votes, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, v: acc + v)
    mean = total / F.nullif(F.size(known), F.lit(0))
    return {
        "n_raters": F.size(known),
        "mean_vote": mean,
        "majority": (mean >= 0.5).cast("int"),
        "contested": (mean > 0) & (mean < 1),
    }


def verbosity_curve(df: DataFrame, length: str, score: str, quality: str, n_bins: int = 4) -> DataFrame:
    """Mean score by length bin among the rows of quality 1.

    Bin edges are interpolated quantiles of the length; bins are closed on the
    right and equal edges are merged.  The edges are selected from a histogram of the
    distinct lengths, which is written once: the frame is read a single time, and
    no task ever holds all lengths of a large table.
    """
    hist = stored(df.groupBy(quality, length).agg(
        F.count("*").alias("__n"), F.sum(score).alias("__s"), F.sum(quality).alias("__q")), "lengths")
    good = F.col(quality) == 1
    enough = (hist.where(good).agg(F.sum("__n")).first()[0] or 0) >= n_bins
    hist = hist.where(good) if enough else hist
    bins = min(n_bins, hist.where(F.col(length).isNotNull()).select(length).distinct().limit(n_bins).count())
    cuts = {f"e{i}": i / bins for i in range(bins + 1)} if bins else {}
    ends = quantiles(hist, [], length, cuts, "__n") if bins else hist.sparkSession.range(1)
    edges = ends.select(F.array_distinct(F.array(*[F.col(c) for c in cuts]).cast("array<double>"))).scalar()
    placed = hist.withColumn("__edges", edges)
    inner = F.slice(F.col("__edges"), 2, F.greatest(F.size("__edges") - 2, F.lit(0)))
    below = F.size(F.filter(inner, lambda e: e < F.col(length)))
    return (
        placed.withColumn("length_bin", below)
        .groupBy("length_bin")
        .agg(F.sum("__n").alias("n"),
             (F.sum(F.col(length) * F.col("__n")) / F.sum("__n")).alias("mean_len"),
             (F.sum("__s") / F.sum("__n")).alias("mean_score"),
             (F.sum("__q") / F.sum("__n")).alias("mean_quality"))
    )


def bias_and_noise(long: DataFrame, judge: str, score: str, truth: str) -> DataFrame:
    """Mean signed error (bias) and error spread (noise) per judge."""
    err = F.col(score) - F.col(truth)
    return long.groupBy(judge).agg(
        F.count(err).alias("n"), F.avg(err).alias("bias"), F.stddev_samp(err).alias("noise"),
        F.avg(F.abs(err)).alias("mean_abs_error"))


def rerun_spread(df: DataFrame, item: str, score: str) -> DataFrame:
    return df.groupBy(item).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"), F.max(score).alias("max"))


def variance_split(spread: DataFrame) -> DataFrame:
    """Within- and between-item variance from the per-item spread table."""
    within = F.sum((F.col("n") - 1) * F.pow("std", F.lit(2))) / F.nullif(F.sum(
        F.when(F.col("std").isNotNull(), F.col("n") - 1)), F.lit(0))
    return spread.agg(
        F.count("*").alias("items"), within.alias("within_var"),
        F.var_samp("mean").alias("between_var"))


def flag_reliability(df: DataFrame, flag: Column, bad: Column, by=()) -> DataFrame:
    """P(bad | flag) counted, beside the value the rates and base rate imply."""
    f, b = flag.cast("int"), bad.cast("int")
    sums = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(f).alias("flagged"), F.sum(b).alias("bad"),
        F.sum(f * b).alias("true_flags"))
    base = F.col("bad") / F.col("n")
    catch = F.col("true_flags") / F.nullif(F.col("bad"), F.lit(0))
    false_rate = (F.col("flagged") - F.col("true_flags")) / F.nullif(F.col("n") - F.col("bad"), F.lit(0))
    return sums.withColumns({
        "base_rate": base, "catch_rate": catch, "false_flag_rate": false_rate,
        "p_bad_given_flag": F.col("true_flags") / F.nullif(F.col("flagged"), F.lit(0)),
        "p_bad_by_bayes": bayes_precision(base, catch, false_rate),
    })


def bayes_precision(base: Column, catch: Column, false_rate: Column) -> Column:
    hit = base * catch
    return hit / F.nullif(hit + (1 - base) * false_rate, F.lit(0.0))


def spread_without_truth(df: DataFrame, keys, scores: dict) -> DataFrame:
    """Range and number of distinct verdicts of several judges per item."""
    values = F.array(*[c.cast("double") for c in scores.values()])
    return df.select(
        *keys, (F.array_max(values) - F.array_min(values)).alias("spread"),
        F.size(F.array_distinct(F.array_compact(values))).alias("n_verdicts"))


def order_swap_flips(df: DataFrame, by, first: Column, swapped: Column) -> DataFrame:
    """Share of pairwise verdicts that change when the two answers swap places."""
    known = first.isNotNull() & swapped.isNotNull()
    return df.where(known).groupBy(*by).agg(
        F.count("*").alias("n"), F.sum((first != swapped).cast("int")).alias("flips"),
        F.avg((first != swapped).cast("double")).alias("flip_rate"))

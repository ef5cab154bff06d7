"""Uncertainty: Beta posteriors, bootstrap, repeat-run intervals, budgets."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.functions.frames import pinned, side_by_side, with_range, with_structs
from gaugeline.functions.hashing import poisson_one, uniform
from gaugeline.operators.replicates import row_replicates
from gaugeline.operators.sampling import draw
from gaugeline.sources.tables import stored

# The priors offered by name.
PRIORS = (("uniform", 1.0, 1.0), ("jeffreys", 0.5, 0.5), ("weak", 2.0, 2.0), ("optimistic", 8.0, 2.0))


def posterior(groups: DataFrame, k="k", n="n", priors=PRIORS) -> DataFrame:
    """Beta posterior per group and prior; the mode only where it is interior."""
    rows = with_structs(groups, ("prior", "a0", "b0"), priors)
    alpha, beta = F.col("a0") + F.col(k), F.col("b0") + F.col(n) - F.col(k)
    rows = rows.withColumns({"alpha": alpha, "beta": beta}).drop("a0", "b0")
    a, b = F.col("alpha"), F.col("beta")
    return rows.withColumns({
        "empirical": F.col(k) / F.nullif(F.col(n), F.lit(0)),
        "mean": a / (a + b),
        "mode": F.when((a > 1) & (b > 1), (a - 1) / (a + b - 2)),
    })


def density_grid(post: DataFrame, keys, points: int, zoom: bool = True) -> DataFrame:
    """Normalised posterior mass on a midpoint grid, per group.

    The grid covers mean +- 8 sd (cut to [0, 1]) so large groups stay resolved;
    the largest log density is taken off first, so nothing underflows.
    """
    a, b = F.col("alpha"), F.col("beta")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    low = F.greatest(F.lit(0.0), F.col("mean") - 8 * sd) if zoom else F.lit(0.0)
    high = F.least(F.lit(1.0), F.col("mean") + 8 * sd) if zoom else F.lit(1.0)
    rows = with_range(post.withColumns({"__lo": low, "__hi": high}), "i", points)
    x = F.col("__lo") + (F.col("i") + 0.5) * (F.col("__hi") - F.col("__lo")) / points
    rows = rows.withColumn("x", x)
    logd = (a - 1) * F.ln("x") + (b - 1) * F.ln(1 - F.col("x"))
    w = Window.partitionBy(*keys)
    rows = rows.withColumn("__l", logd).withColumn("__d", F.exp(F.col("__l") - F.max("__l").over(w)))
    rows = rows.withColumn("mass", F.col("__d") / F.sum("__d").over(w))
    return rows.withColumn("step", (F.col("__hi") - F.col("__lo")) / points).drop("__lo", "__hi", "__l", "__d")


def credible_interval(post: DataFrame, keys, level=0.95, points=4000) -> DataFrame:
    grid = density_grid(post, keys, points)
    tail = (1 - level) / 2
    w = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("cdf", F.sum("mass").over(w))
    return grid.groupBy(*keys).agg(
        F.min(F.when(F.col("cdf") >= tail, F.col("x"))).alias("lo"),
        F.min(F.when(F.col("cdf") >= 1 - tail, F.col("x"))).alias("hi"))


def prob_above(post: DataFrame, keys, cut: float, points=4000) -> DataFrame:
    grid = density_grid(post, keys, points)
    return grid.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("x") > cut, F.col("mass"))), F.lit(0.0)).alias("p_above"))


def curve(post: DataFrame, keys, points=401) -> DataFrame:
    grid = density_grid(post, keys, points, zoom=False)
    return grid.select(*keys, "i", "x", (F.col("mass") / F.col("step")).alias("density"))


def unit_of(key: str, units: int | None) -> Column:
    """Resampling unit of a row: a hash group of its key, or the key itself."""
    hashed = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(units or 1))
    return F.col(key).cast("string") if units is None else hashed.cast("string")


def replicates_of(cells: DataFrame, columns, replicates: int, salt) -> DataFrame:
    """Every cell of a unit once per replicate that draws the unit, with its Poisson weight ``__w``."""
    rows = cells.groupBy("__unit").agg(F.collect_list(F.struct(*columns)).alias("__g"))  # a struct per cell of one unit
    rows = with_range(rows, "__b", replicates)
    key = F.concat("__unit", F.lit(":"), F.col("__b").cast("string"))
    rows = pinned(rows, {"__w": poisson_one(uniform(key, salt))}).where("__w > 0")
    return rows.select("__b", "__w", F.inline("__g"))


def unit_sums(df: DataFrame, key: str, value: Column, by=(), units: int | None = 1000) -> DataFrame:
    """Sums per resampling unit: the only pass over the rows that a bootstrap needs.

    With ``units`` rows fall into that many hash groups, and whole groups are resampled: the interval of the mean then costs
    units x replicates numbers, whatever the row count, and its ends differ from the row bootstrap's by about 1 / sqrt(2 * units) of
    its width.  With None every row is a unit of its own, which is the plain bootstrap and costs rows x replicates.
    """
    return df.where(value.isNotNull()).groupBy(*by, unit_of(key, units).alias("__unit")).agg(
        F.sum(value).alias("__s"), F.count("*").alias("__c"))


def replicate_means(sums: DataFrame, by=(), replicates: int = 2000, salt="boot") -> DataFrame:
    """Poisson bootstrap of the mean from unit sums.

    A unit has the same weight in all groups, so differences between groups within one replicate are paired.
    Each weight is drawn once, beside the sums it multiplies.
    """
    rows = replicates_of(sums, [*by, "__s", "__c"], replicates, salt)
    return rows.groupBy(*by, "__b").agg(
        (F.sum(F.col("__w") * F.col("__s")) / F.sum(F.col("__w") * F.col("__c"))).alias("__m"))


def rank_pick(df: DataFrame, by, value: str, ranks: dict) -> DataFrame:
    """Order statistics per group; ``ranks`` maps a name to a 0-based rank
    or to a function of the row count."""
    w = Window.partitionBy(*by)
    rows = df.where(F.col(value).isNotNull()).withColumns({
        "__r": F.row_number().over(w.orderBy(value)) - 1, "__n": F.count("*").over(w)})
    picks = []
    for name, rank in ranks.items():
        at = rank(F.col("__n")) if callable(rank) else F.lit(rank)
        picks.append(F.max(F.when(F.col("__r") == at, F.col(value))).alias(name))
    return rows.groupBy(*by).agg(*picks)


def percentile_ranks(low=0.025, high=0.975) -> dict:
    return {"lo": lambda n: F.floor(F.lit(low) * n), "hi": lambda n: F.floor(F.lit(high) * n)}


def replicates_by_row(df, key, value: Column, by=(), replicates=2000, salt="boot") -> DataFrame:
    """Mean of every replicate, rows being the units."""
    sums = row_replicates(df, key, value, by, replicates, salt)
    return sums.select(*by, "__b", (F.col("__s") / F.nullif(F.col("__c"), F.lit(0.0))).alias("__m"))


def bootstrap_interval(df, key, value: Column, by=(), units: int | None = None, replicates=2000, salt="boot") -> DataFrame:
    """Percentile interval of the mean per group; rows are resampled, or hash groups of them where ``units`` gives their number."""
    if units is None:
        reps = replicates_by_row(df, key, value, by, replicates, salt)
        point = df.where(value.isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    else:
        sums = unit_sums(df, key, value, by, units)
        reps = replicate_means(sums, by, replicates, salt)
        point = sums.groupBy(*by).agg(F.sum("__c").alias("n"), (F.sum("__s") / F.sum("__c")).alias("mean"))
    picks = rank_pick(reps, by, "__m", percentile_ranks())
    return point.join(picks, list(by)) if by else side_by_side(point, picks)


def delta_interval(df, key, value: Column, arm: str, arms, by=(), units: int | None = None, replicates=2000, salt="boot"):
    """Interval of mean(second arm) - mean(first arm), replicate by replicate; rows of one key in both arms are paired."""
    a, b = arms
    if units is None:
        reps = replicates_by_row(df, key, value, [*by, arm], replicates, salt)
        point = df.where(value.isNotNull()).groupBy(*by, arm).agg(F.avg(value).alias("__mean"))
    else:
        sums = unit_sums(df, key, value, [*by, arm], units)
        reps = replicate_means(sums, [*by, arm], replicates, salt)
        point = sums.groupBy(*by, arm).agg((F.sum("__s") / F.sum("__c")).alias("__mean"))

    def side(name, m):
        return F.max(F.when(F.col(arm) == name, F.col(m)))

    deltas = reps.groupBy(*by, "__b").agg((side(b, "__m") - side(a, "__m")).alias("__d"))
    picks = rank_pick(deltas, by, "__d", percentile_ranks())
    point = point.groupBy(*by).agg((side(b, "__mean") - side(a, "__mean")).alias("delta"))
    out = point.join(picks, list(by)) if by else side_by_side(point, picks)
    return out.withColumn("includes_zero", (F.col("lo") <= 0) & (F.col("hi") >= 0))


def bootstrap_coverage(df, key, value: str, n: int, draws: int, truth: Column, total: Column, replicates=500, salt="cover"):
    """Per small draw: its bootstrap interval of the mean and whether that contains the full-pool value."""
    drawn = stored(draw(df, key, n, range(draws), total), "coverage")
    ends = bootstrap_interval(drawn, key, F.col(value), ["seed"], None, replicates, salt)
    return ends.withColumn("truth", truth).withColumn("covers", (F.col("lo") <= F.col("truth")) & (F.col("truth") <= F.col("hi")))


def coverage(df, key, correct: str, n: int, draws: int, truth: Column, total: Column, level=0.95):
    """Share of credible intervals of small draws, uniform prior, that contain the full-pool value."""
    per_draw = draw(df, key, n, range(draws), total).groupBy("seed").agg(
        F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("k"))
    post = posterior(per_draw, priors=(("uniform", 1.0, 1.0),))
    ends = credible_interval(post, ["seed"], level)
    return per_draw.join(ends, "seed").withColumn("truth", truth).withColumn(
        "covers", (F.col("lo") <= F.col("truth")) & (F.col("truth") <= F.col("hi")))


def width_table(run_means: DataFrame, condition: str, value: str, low_rank, high_rank) -> DataFrame:
    """Repeat-run interval per condition and its width against the narrowest."""
    picks = rank_pick(run_means, [condition], value, {"lo": low_rank, "hi": high_rank})
    picks = picks.withColumn("width", F.greatest(F.col("hi") - F.col("lo"), F.lit(0.01)))
    return picks.withColumn("multiplier", F.col("width") / F.min("width").over(Window.partitionBy()))


def uncertainty_budget(df, by, score: Column, reference: Column) -> DataFrame:
    """Sampling variance, judge variance and squared bias combined per segment."""
    err = score - reference
    parts = df.groupBy(*by).agg(
        F.count(err).alias("n"), F.var_samp(reference).alias("var_sampling"),
        F.var_samp(err).alias("var_judge"), F.avg(err).alias("bias"))
    return parts.withColumn("combined", F.sqrt(
        F.col("var_sampling") / F.col("n") + F.col("var_judge") / F.col("n") + F.col("bias") * F.col("bias")))


def histogram(df, value: Column, width: float, low: float, high: float, system: str, systems) -> DataFrame:
    """Counts per fixed bin and system; every bin is present, empty ones with 0."""
    n_bins = int(round((high - low) / width)) + 1
    bin_ = F.floor((value - low) / width).cast("int")
    counts = df.groupBy(bin_.alias("bin")).agg(
        *[F.sum((F.col(system) == s).cast("int")).alias(f"n_{s}") for s in systems])
    bins = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    zero = [F.coalesce(F.col(f"n_{s}"), F.lit(0)).alias(f"n_{s}") for s in systems]
    return bins.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("bin_start"), *zero)

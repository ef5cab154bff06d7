"""Metric choice, A/B winners, Simpson check, multiple tests, optimism."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.functions.frames import unpivot
from gaugeline.functions.scores import normal_cdf
from gaugeline.operators import intervals as iv
from gaugeline.operators.replicates import row_replicates
from gaugeline.operators.selection import meet, floor_rank, order_statistics, quantiles
from gaugeline.sources.tables import stored


@dataclass(frozen=True)
class Metric:
    """``agg(score, weight)`` is an aggregate, or None for an order statistic: the value at floor(share * n), or the interpolated quantile."""

    id: str
    agg: Callable[[Column, Column], Column] | None
    higher_is_better: bool
    share: float | None = None
    interpolated: bool = False


class MetricRegistry:
    """Metrics over a score histogram."""

    def __init__(self, metrics=()):
        self.metrics = {m.id: m for m in metrics}

    def register(self, id, agg, higher_is_better):
        self.metrics[id] = Metric(id, agg, higher_is_better)
        return self

    def register_rank(self, id, share, higher_is_better, interpolated=False):
        self.metrics[id] = Metric(id, None, higher_is_better, share, interpolated)
        return self

    def over(self, hist: DataFrame, by, score: str, weight: str) -> DataFrame:
        """Every metric per group of a histogram; ranks are selected, not collected."""
        s, w = F.col(score), F.col(weight)
        by, all_ = list(by), self.metrics.values()
        out = hist.groupBy(*by).agg(F.sum(w).cast("long").alias("n"), *[m.agg(s, w).alias(m.id) for m in all_ if m.agg])
        plain = {m.id: floor_rank(m.share) for m in all_ if not m.agg and not m.interpolated}
        between = {m.id: m.share for m in all_ if not m.agg and m.interpolated}
        for table in ([order_statistics(hist, by, score, plain, weight)] if plain else []) + ([quantiles(hist, by, score, between, weight)] if between else []):
            out = meet(out, table, by)
        return out.select(*by, "n", *self.metrics)


def _weighted_mean(s, w):
    return F.sum(s * w) / F.sum(w)


def _std_pop(s, w):
    mean = F.sum(s * w) / F.sum(w)
    return F.sqrt(F.greatest(F.sum(s * s * w) / F.sum(w) - mean * mean, F.lit(0.0)))


def default_metrics() -> MetricRegistry:
    return MetricRegistry([
        Metric("mean", _weighted_mean, True),
        Metric("median", None, True, 0.5, True),
        Metric("share_4_up", lambda s, w: F.sum(F.when(s >= 4, w).otherwise(0)) / F.sum(w), True),
        Metric("p5", None, True, 0.05),
        Metric("std", _std_pop, False),
    ])


def score_histogram(df: DataFrame, by, score: str) -> DataFrame:
    """Counts per distinct score; all metrics read this."""
    return df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count("*").alias("__w"))


def metric_panel(df: DataFrame, by, score: str, registry: MetricRegistry | None = None) -> DataFrame:
    hist = stored(score_histogram(df, by, score), "scores")
    return (registry or default_metrics()).over(hist, by, score, "__w")


def bootstrap_panel(df: DataFrame, key: str, by, score: str, registry: MetricRegistry | None = None, units: int | None = None,
                    replicates: int = 500, salt="panel") -> DataFrame:
    """Value and percentile interval of every registered metric, from a Poisson bootstrap of the score histogram.

    Rows are resampled, or hash groups of them where ``units`` gives their number.
    """
    registry = registry or default_metrics()
    known = df.where(F.col(score).isNotNull())
    if units is None:
        hist = row_replicates(known, key, F.lit(1.0), [*by, score], replicates, salt).where("__c > 0").withColumnRenamed("__c", "__w")
    else:
        cells = known.groupBy(*by, iv.unit_of(key, units).alias("__unit"), score).agg(F.count("*").alias("__n"))
        rows = iv.replicates_of(cells, [*by, score, "__n"], replicates, salt)
        hist = rows.groupBy(*by, "__b", score).agg(F.sum(F.col("__w") * F.col("__n")).alias("__w"))
    values = {i: F.col(i) for i in registry.metrics}
    long = unpivot(registry.over(stored(hist, "replicates"), [*by, "__b"], score, "__w"), [*by, "__b"], values, "metric", "value")
    ends = iv.rank_pick(long, [*by, "metric"], "value", iv.percentile_ranks())
    return unpivot(metric_panel(df, by, score, registry), by, values, "metric", "value").join(ends, [*by, "metric"])


def metric_winners(panel: DataFrame, system: str, systems, by=(), registry=None, tie=0.001) -> DataFrame:
    """Winner per metric, direction aware; a difference below ``tie`` is a tie."""
    registry = registry or default_metrics()
    a, b = systems
    long = unpivot(panel, [*by, system], {i: F.col(i) for i in registry.metrics}, "metric", "value")
    wide = long.groupBy(*by, "metric").agg(
        F.max(F.when(F.col(system) == a, F.col("value"))).alias(f"value_{a}"),
        F.max(F.when(F.col(system) == b, F.col("value"))).alias(f"value_{b}"))
    lower = [i for i, m in registry.metrics.items() if not m.higher_is_better]
    diff = F.col(f"value_{b}") - F.col(f"value_{a}")
    diff = F.when(F.col("metric").isin(lower), -diff).otherwise(diff)
    return wide.withColumn("winner", F.when(F.abs(diff) < tie, "tie").when(diff > 0, b).otherwise(a))


def scorecard_winners(cards: DataFrame, system: str, systems, metrics, lead: float = 0.01) -> DataFrame:
    """Mean per scorecard metric and system; a system wins a metric only with a lead above ``lead``."""
    a, b = systems
    means = cards.groupBy(system).agg(*[F.avg(m).alias(m) for m in metrics])
    long = unpivot(means, [system], {m: F.col(m) for m in metrics}, "metric", "value")
    wide = long.groupBy("metric").agg(*[F.max(F.when(F.col(system) == s, F.col("value"))).alias(f"mean_{s}") for s in systems])
    diff = F.col(f"mean_{b}") - F.col(f"mean_{a}")
    return wide.withColumn("winner", F.when(diff > lead, b).when(diff < -lead, a).otherwise("tie"))


def wins(winners: DataFrame, by=()) -> DataFrame:
    return winners.groupBy(*by, "winner").agg(F.count("*").alias("wins"))


def segment_sums(df: DataFrame, keys, value: Column) -> DataFrame:
    return df.where(value.isNotNull()).groupBy(*keys).agg(
        F.sum(value).alias("value_sum"), F.count("*").alias("n_rows"))


def simpson(sums: DataFrame, segment: str, system: str, systems) -> DataFrame:
    """Overall direction against the direction inside every segment."""
    a, b = systems

    def mean(name):
        hit = F.col(system) == name
        return F.sum(F.when(hit, F.col("value_sum"))) / F.nullif(F.sum(F.when(hit, F.col("n_rows"))), F.lit(0))

    per = sums.groupBy(segment).agg((mean(b) - mean(a)).alias("delta"))
    overall = sums.agg(mean(b) - mean(a)).scalar()
    rows = per.withColumn("overall_delta", overall)
    against = F.signum("delta") == -F.signum("overall_delta")
    return rows.withColumns({
        "against_overall": F.coalesce(against & (F.col("overall_delta") != 0), F.lit(False)),
    }).withColumn("reversal", F.min("against_overall").over(Window.partitionBy()))


def two_proportion(df: DataFrame, k1, n1, k2, n2) -> DataFrame:
    """z and two-sided p of the difference of two shares; p = 1 without spread."""
    p1, p2 = F.col(k1) / F.col(n1), F.col(k2) / F.col(n2)
    pool = (F.col(k1) + F.col(k2)) / (F.col(n1) + F.col(n2))
    se = F.sqrt(pool * (1 - pool) * (1.0 / F.col(n1) + 1.0 / F.col(n2)))
    out = df.withColumn("z", F.when(se > 0, (p2 - p1) / se))
    p = 2 * (1 - normal_cdf(F.abs(F.col("z"))))
    return out.withColumn("p_value", F.coalesce(F.least(F.lit(1.0), p), F.lit(1.0)))


def corrected(tests: DataFrame, ids, alpha=0.05) -> DataFrame:
    """Bonferroni, Holm and Benjamini-Hochberg p-values of one family.

    The family has one row per test, already aggregated.
    """
    family = Window.partitionBy()
    up = family.orderBy("p_value", *ids)
    m = F.count("*").over(family)
    out = tests.withColumns({"__m": m, "__i": F.row_number().over(up)})
    upto = up.rowsBetween(Window.unboundedPreceding, 0)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    one = F.lit(1.0)
    out = out.withColumns({
        "p_bonferroni": F.least(one, F.col("p_value") * F.col("__m")),
        "p_holm": F.least(one, F.max(F.col("p_value") * (F.col("__m") - F.col("__i") + 1)).over(upto)),
        "p_bh": F.least(one, F.min(F.col("p_value") * F.col("__m") / F.col("__i")).over(after)),
    })
    return out.withColumns({
        "raw_hit": F.col("p_value") < alpha,
        "holm_hit": F.col("p_holm") < alpha,
        "bh_hit": F.col("p_bh") < alpha,
    }).drop("__m", "__i")


def split_accuracy(df: DataFrame, variant: str, split: str, right: Column, splits, n: Column | None = None) -> DataFrame:
    """Accuracy of every variant on every split, one column per split; ``n`` is how often a row counts."""
    n = F.lit(1) if n is None else n

    def accuracy(s):
        mine = F.col(split) == s
        return F.sum(F.when(mine & right, n).when(mine, 0)) / F.sum(F.when(mine, n))

    return df.groupBy(variant).agg(*[accuracy(s).alias(f"acc_{s}") for s in splits])


def lucky_winner(table: DataFrame, variant: str, dev="acc_dev", sealed="acc_test") -> DataFrame:
    """Best of the first N variants on dev, its sealed score and the gap, per N."""
    w = Window.orderBy(variant).rowsBetween(Window.unboundedPreceding, 0)
    best = F.min_by(F.struct(variant, dev, sealed), F.struct(-F.col(dev), F.col(variant))).over(w)
    out = table.select(F.count("*").over(w).alias("n_variants"), best.alias("best"))
    return out.select(
        "n_variants", F.col(f"best.{variant}").alias("winner"), F.col(f"best.{dev}").alias("dev"),
        F.col(f"best.{sealed}").alias("sealed"), (F.col(f"best.{dev}") - F.col(f"best.{sealed}")).alias("optimism"))


def holdout_gap(table: DataFrame, version: str, dev="acc_dev", sealed="acc_test") -> DataFrame:
    w = Window.orderBy(version).rowsBetween(Window.unboundedPreceding, 0)
    return table.select(
        version, dev, sealed, (F.col(dev) - F.col(sealed)).alias("gap"), F.max(dev).over(w).alias("best_dev"))


def variant_spread(df: DataFrame, item: str, score: str, pass_mark: float) -> DataFrame:
    """Range of scores over equivalent variants of an item, and verdict flips."""
    ok = (F.col(score) >= pass_mark).cast("int")
    return df.groupBy(item).agg(
        F.count(score).alias("n"), (F.max(score) - F.min(score)).alias("score_range"),
        (F.max(ok) != F.min(ok)).alias("flips"))

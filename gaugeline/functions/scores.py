"""Column builders for scores, rates and order statistics."""

from pyspark.sql import Column, functions as F


def rate(hit: Column) -> Column:
    return F.avg(hit.cast("double"))


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the denominator is 0."""
    return num / F.nullif(den, F.lit(0))


def f_measure(precision: Column, recall: Column) -> Column:
    """F1; 0 when either side is 0 or undefined."""
    f1 = 2 * precision * recall / F.nullif(precision + recall, F.lit(0.0))
    return F.coalesce(f1, F.lit(0.0))


def nearest_half(raw: Column) -> Column:
    """Nearest half point, ties to even, kept in [1, 5]; NULL stays NULL."""
    half = F.bround(raw * 2, 0) / 2
    return F.when(raw.isNotNull(), F.least(F.lit(5.0), F.greatest(F.lit(1.0), half)))


def half_step_score(value: Column) -> Column:
    """Map a non-negative size to a half-step score in [1, 5], halves up."""
    score = F.least(F.lit(5.0), F.lit(1.0) + F.floor(value / 50.0 * 2 + 0.5) / 2.0)
    return F.when(value.isNotNull(), score)


def kappa(p_o: Column, p_a: Column, p_b: Column) -> Column:
    """Cohen's kappa of two binary raters from agreement and shares of ones."""
    p_e = p_a * p_b + (1 - p_a) * (1 - p_b)
    return F.when(p_e == 1.0, F.when(p_o == 1.0, 1.0).otherwise(0.0)).otherwise(
        (p_o - p_e) / (1 - p_e)
    )


def normal_cdf(z: Column) -> Column:
    """Standard normal cdf, Abramowitz and Stegun 26.2.17 (error below 7.5e-8)."""
    x = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * x)
    poly = t * (
        0.319381530
        + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    upper = 0.3989422804014327 * F.exp(-x * x / 2.0) * poly
    return F.when(z >= 0, 1.0 - upper).otherwise(upper)

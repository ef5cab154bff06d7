"""Randomness as a function of the row key.

A draw that depends only on (salt, key) gives the same answer for any
partitioning, any executor loss and any re-run, and another SQL engine can
repeat it.  ``rand(seed)`` has none of these properties.
"""

from pyspark.sql import Column, functions as F

TWO_32 = 4294967296.0


def _as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def key_hash(key: Column, salt) -> Column:
    """Hex digest that orders the rows at random for one salt."""
    return F.md5(F.concat(_as_col(salt).cast("string"), F.lit(":"), key.cast("string")))


def hash_uniform(digest: Column) -> Column:
    """Uniform number in [0, 1) from a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def uniform(key: Column, salt) -> Column:
    return hash_uniform(key_hash(key, salt))


def poisson_one(u: Column) -> Column:
    """Poisson(1) draw by inverse cdf.

    Counts go up to 12: the tail above has probability 6e-11, below the 2^-32 resolution of ``u``.
    """
    out, cdf, term = None, 0.0, 0.36787944117144233
    for k in range(12):
        cdf += term
        out = F.when(u < cdf, k) if out is None else out.when(u < cdf, k)
        term /= k + 1
    return out.otherwise(12)

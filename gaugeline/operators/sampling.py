"""Splits, draws and resampling from key hashes.

Exact draws of n rows keep the n smallest hashes.  The hash threshold
t = (n + 8 sqrt(n) + 64) / N lets about n rows through, so only those are ever
ranked or shuffled, whatever the size of the table; a draw that would come out
short (probability below 1e-15) raises an error instead of being returned.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.functions.frames import with_grid
from gaugeline.functions.hashing import hash_uniform, key_hash, uniform
from gaugeline.operators.numbering import running_number
from gaugeline.operators.ranks import rank_directory


def hash_split(df: DataFrame, key: str, train_frac: float, salt) -> DataFrame:
    """Train / test by hash threshold: no shuffle, stable when rows are added."""
    u = uniform(F.col(key), salt)
    return df.withColumn("split", F.when(u < train_frac, "train").otherwise("test"))


def _threshold(n: Column, total: Column) -> Column:
    return (n + 8 * F.sqrt(n) + 64) / total


def draw(df: DataFrame, key: str, n: int, seeds, total: Column | None = None) -> DataFrame:
    """``n`` rows without replacement per seed, all seeds in one job.

    Adds ``seed`` and ``draw_rank``; the rows of rank <= m are the draw of size
    m, so one draw serves every smaller size.  A table of fewer than ``n`` rows
    is drawn whole.
    """
    total = total if total is not None else df.agg(F.count("*")).scalar()
    rows = with_grid(df, "seed", list(seeds))
    rows = rows.withColumn("__h", key_hash(F.col(key), F.col("seed")))
    rows = rows.where(hash_uniform(F.col("__h")) < _threshold(F.lit(float(n)), total))
    per_seed = Window.partitionBy("seed")
    ranked = rows.withColumns({
        "draw_rank": F.row_number().over(per_seed.orderBy("__h", key)),
        "__have": F.count("*").over(per_seed),
    })
    short = F.col("__have") < F.least(F.lit(n), total)
    guard = F.when(short, F.raise_error(F.lit("draw came out short"))).otherwise(F.lit(True))
    return ranked.where(guard).where(F.col("draw_rank") <= n).drop("__have", "__h")


def draw_poisson(df: DataFrame, key: str, rate: Column, seeds) -> DataFrame:
    """Bernoulli draws: no shuffle at all, but the size varies."""
    rows = with_grid(df, "seed", list(seeds))
    return rows.where(uniform(F.col(key), F.col("seed")) < rate)


def nth_hash(df: DataFrame, digest: str, n: Column, total: Column) -> Column:
    """The n-th smallest digest, found without sorting the table.

    A histogram of 4096 cells below the threshold tells which cell holds the
    n-th digest; only that cell, about n / 4096 rows, is ranked.
    """
    top = F.least(F.lit(1.0), _threshold(n.cast("double"), total))
    u = hash_uniform(F.col(digest))
    cells = df.where(u < top).select(digest, F.floor(u / top * 4096).alias("__cell"))
    w = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    hist = cells.groupBy("__cell").agg(F.count("*").alias("__c")).withColumn("__cum", F.sum("__c").over(w))
    hit = hist.where(F.col("__cum") >= n).agg(
        F.min_by(F.struct("__cell", (n - F.col("__cum") + F.col("__c")).alias("__k")), "__cell")).scalar()
    inside = cells.where(F.col("__cell") == hit["__cell"])
    ranked = inside.select(digest, F.row_number().over(Window.orderBy(digest)).alias("__rank"))
    return ranked.where(F.col("__rank") == hit["__k"]).agg(F.max(digest)).scalar()


def holdout(df: DataFrame, key: str, pool: int, salt, keep_for_train: int = 200) -> DataFrame:
    """Fixed held-out pool; at least ``keep_for_train`` rows stay for training.

    The pool is cut at the hash of its last row, so the role of every row is
    decided by a comparison and the table itself is never shuffled.
    """
    n = df.agg(F.count("*")).scalar()
    hashed = df.withColumn("__h", key_hash(F.col(key), salt))
    size = F.greatest(F.least(F.lit(pool), n - keep_for_train), F.lit(0))
    cut = nth_hash(hashed.select("__h"), "__h", size, n)
    role = F.when(F.col("__h") <= cut, "pool").otherwise("train")
    return hashed.withColumn("role", role).drop("__h")


def stratified_roles(df: DataFrame, key: str, stratum: str, shares: dict, salt) -> DataFrame:
    """Role per row with the given shares inside every stratum, by key hash.

    Hash thresholds need no shuffle and cannot be hurt by one huge stratum; the
    shares are met up to sampling error, which shrinks as strata grow.
    """
    u = uniform(F.col(key), F.concat(F.lit(f"{salt}:"), F.col(stratum)))
    edge, role = 0.0, None
    names = list(shares)
    for name in names[:-1]:
        edge += shares[name]
        role = F.when(u < edge, name) if role is None else role.when(u < edge, name)
    return df.withColumns({"role": role.otherwise(names[-1])}).withColumn(
        "sealed", F.col("role") == F.lit("test"))


def quota_sample(df: DataFrame, key: str, stratum: str, quotas: dict, salt) -> DataFrame:
    """Exact quota per stratum: the rows of smallest hash, pre-cut by threshold.

    The stratum sizes come back as one scalar, so rows never meet by stratum
    before the cut; after it about quota rows per stratum are left to rank.
    """
    names = list(quotas)
    sizes = df.agg(F.struct(*[F.count_if(F.col(stratum) == s).alias(str(i)) for i, s in enumerate(names)])).scalar()
    quota, size = F.lit(0), F.lit(0)
    for i, s in enumerate(names):
        quota = F.when(F.col(stratum) == s, quotas[s]).otherwise(quota)
        size = F.when(F.col(stratum) == s, F.col("__sizes")[str(i)]).otherwise(size)
    rows = df.withColumn("__sizes", sizes).withColumns({"__quota": quota, "__n": size}).drop("__sizes")
    rows = rows.where("__quota > 0").withColumn("__h", key_hash(F.col(key), salt))
    rows = rows.where(hash_uniform(F.col("__h")) < _threshold(F.col("__quota").cast("double"), F.col("__n")))
    w = Window.partitionBy(stratum)
    ranked = rows.withColumns({
        "__rank": F.row_number().over(w.orderBy("__h", key)),
        "__have": F.count("*").over(w),
    })
    short = F.col("__have") < F.least(F.col("__quota"), F.col("__n"))
    guard = F.when(short, F.raise_error(F.lit("quota came out short"))).otherwise(F.lit(True))
    return ranked.where(guard).where(F.col("__rank") <= F.col("__quota")).drop(
        "__rank", "__have", "__h", "__n", "__quota")


def draw_replace(df: DataFrame, key: str, n: int, seeds, salt="replace") -> DataFrame:
    """``n`` rows with replacement per seed, as (seed, copies) beside each key drawn.

    Draw j of a seed is the row at rank floor(u * N) of the keys in hash order; the ranks are looked up in a directory, none is sorted.
    """
    ranks = rank_directory(df, key, salt)
    picks = with_grid(df.sparkSession.range(n).withColumnRenamed("id", "__j"), "seed", list(seeds))
    at = F.floor(uniform(F.concat_ws(":", F.lit("pick"), "seed", "__j"), salt) * ranks.total)
    picks = picks.groupBy("seed", at.alias("at")).agg(F.count("*").cast("int").alias("copies"))
    return ranks.look_up(picks).groupBy("seed", key).agg(F.sum("copies").cast("int").alias("copies"))


def _skews(df: DataFrame, label: str, skews):
    """Class counts and, per skew, the weight of every class: 1 for the majority, max(0.001, 1 - skew) for the others."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    top = min(counts, key=lambda c: (-counts[c], c)) if counts else None
    weights = {float(s): {c: 1.0 if c == top else max(1e-3, 1 - s) for c in counts} for s in skews}
    return counts, top, weights


def _skew_uniform(key: str, salt, skew: float) -> Column:
    return uniform(F.col(key), F.lit(f"{salt}:{round(skew * 100)}"))


def _by_class(label: str, values: dict) -> Column:
    out = F.lit(0.0)
    for c, v in values.items():
        out = F.when(F.col(label) == c, float(v)).otherwise(out)
    return out


def skewed_copies(df: DataFrame, key: str, label: str, n: int, skews, salt) -> DataFrame:
    """Weighted draw of exactly ``n`` with replacement for each skew, as copies per row.

    A row expected e = n * w / W times is copied floor(e) times; the left-over places go one each to the rows that come
    first in a Pareto order of the fractions, so the sizes are exact.  Returns the rows drawn with ``skew``, ``copies`` and
    the majority class ``top``; no row is physically repeated.
    """
    counts, top, weights = _skews(df, label, skews)
    out = None
    for skew, w in weights.items():
        total = sum(counts[c] * w[c] for c in counts)
        want = {c: n * w[c] / total for c in counts}
        left = n - sum(counts[c] * int(want[c]) for c in counts)
        rows = df.withColumns({"skew": F.lit(skew), "top": F.lit(top)})
        whole = rows.withColumn("copies", _by_class(label, {c: int(v) for c, v in want.items()}).cast("int")).where("copies > 0")
        part, u = _by_class(label, {c: v - int(v) for c, v in want.items()}), _skew_uniform(key, salt, skew)
        more = rows.where(part > 0).orderBy(u * (1 - part) / (part * (1 - u)), key).limit(left).withColumn("copies", F.lit(1))
        drawn = whole.unionByName(more)
        out = drawn if out is None else out.unionByName(drawn)
    names = [c for c in out.columns if c != "copies"]
    return out.groupBy(*names).agg(F.sum("copies").alias("copies"))


def skewed_draw(df: DataFrame, key: str, label: str, n: int, skews, salt) -> DataFrame:
    """Weighted draw of exactly ``n`` rows without replacement for each skew (the whole table if it is smaller).

    The rows of least -ln(u) / w: successive draws with probabilities in proportion to w.
    """
    _, top, weights = _skews(df, label, skews)
    out = None
    for skew, w in weights.items():
        rows = df.withColumns({"skew": F.lit(skew), "top": F.lit(top)})
        order = -F.ln(1 - _skew_uniform(key, salt, skew)) / _by_class(label, w)
        drawn = rows.orderBy(order, key).limit(n)
        out = drawn if out is None else out.unionByName(drawn)
    return out


def batches(df: DataFrame, key: str, size: int, partitions: int | None = None) -> DataFrame:
    """The rows with ``batch``: groups of exactly ``size`` rows in order of the key, only the last one shorter.

    One running numbering of the whole table, from range partitions and their offsets.  Rows of one key get neighbouring numbers, in an order
    of a hash of the whole row; a null key comes first.
    """
    numbered = running_number(df, [F.asc_nulls_first(key), F.xxhash64(*df.columns)], "__number", partitions=partitions)
    return numbered.withColumn("batch", F.floor(F.col("__number") / size).cast("long")).drop("__number")

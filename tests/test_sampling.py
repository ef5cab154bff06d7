import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.hashing import poisson_one, uniform
from gaugeline.operators import sampling as sp


def digest(salt, key):
    return hashlib.md5(f"{salt}:{key}".encode()).hexdigest()


def smallest(keys, salt, n):
    return set(sorted(keys, key=lambda k: digest(salt, k))[:n])


def test_uniform_is_the_key_hash(spark):
    rows = spark.range(50).select("id", uniform(F.col("id"), "s").alias("u")).collect()
    assert all(r.u == int(digest("s", r.id)[:8], 16) / 2**32 for r in rows)


@pytest.mark.parametrize("n_rows", [0, 7, 500, 20000])
def test_draw_takes_the_smallest_hashes(spark, n_rows):
    df = spark.range(n_rows).withColumnRenamed("id", "k")
    got = {}
    for r in sp.draw(df, "k", 60, [0, 1, 2]).collect():
        got.setdefault(r.seed, set()).add(r.k)
    want = {s: smallest(range(n_rows), s, 60) for s in (0, 1, 2)} if n_rows else {}
    assert got == want


def test_draw_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {(r.seed, r.k) for r in sp.draw(df.repartition(1), "k", 50, [3, 4]).collect()}
    b = {(r.seed, r.k) for r in sp.draw(df.repartition(23), "k", 50, [3, 4]).collect()}
    assert a == b


def test_short_draw_is_an_error(spark):
    df = spark.range(100000).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="short"):  # a wrong row count makes the threshold too low
        sp.draw(df.where("k < 20000"), "k", 60, [0], total=F.lit(100000)).collect()


@pytest.mark.parametrize("n_rows, pool, expected", [(300, 1000, 100), (5000, 1000, 1000), (150, 1000, 0), (50000, 3000, 3000)])
def test_holdout_size_and_floor(spark, n_rows, pool, expected):
    df = spark.range(n_rows).withColumnRenamed("id", "k")
    rows = sp.holdout(df, "k", pool, "p").collect()
    got = {r.k for r in rows if r.role == "pool"}
    assert len(rows) == n_rows and got == smallest(range(n_rows), "p", expected)


def test_split_is_stable_when_rows_are_added(spark):
    small = {r.k: r.split for r in sp.hash_split(spark.range(100).toDF("k"), "k", 0.7, "s").collect()}
    large = {r.k: r.split for r in sp.hash_split(spark.range(1000).toDF("k"), "k", 0.7, "s").collect()}
    assert all(large[k] == v for k, v in small.items())
    assert 620 < sum(v == "train" for v in large.values()) < 780


def test_stratified_roles(spark):
    df = spark.range(8000).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("s"))
    rows = sp.stratified_roles(df, "k", "s", {"dev": 0.5, "test": 0.3, "calibration": 0.2}, "r").collect()
    for s in "ab":
        mine = [r for r in rows if r.s == s]
        assert abs(sum(r.role == "test" for r in mine) / len(mine) - 0.3) < 0.04
    assert all(r.sealed == (r.role == "test") for r in rows)


def test_quota_with_one_huge_stratum(spark):
    df = spark.range(9000).select(F.col("id").alias("k"), F.when(F.col("id") < 8900, "big").otherwise("small").alias("s"))
    rows = sp.quota_sample(df, "k", "s", {"big": 50, "small": 500}, "q").collect()
    assert {r.k for r in rows if r.s == "big"} == smallest(range(8900), "q", 50)
    assert sum(r.s == "small" for r in rows) == 100  # fewer rows than the quota: all of them


def test_skewed_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "min").otherwise("maj").alias("c"))
    rows = sp.skewed_copies(df, "k", "c", 600, [0.0, 0.9, 1.0], "s").groupBy("skew", "c", "top").agg(F.sum("copies").alias("n")).collect()
    n = {(r["skew"], r.c): r.n for r in rows}
    assert {r.top for r in rows} == {"maj"}
    for skew, share in ((0.0, 1 / 3), (0.9, 0.1 / 2.1), (1.0, 0.001 / 2.001)):
        total = n[(skew, "maj")] + n.get((skew, "min"), 0)
        assert abs(total - 600) < 75 and abs(n.get((skew, "min"), 0) / total - share) < 0.06


def test_copies_can_exceed_one(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)], "k int, c string")
    total = sp.skewed_copies(df, "k", "c", 1000, [0.0], "s").agg(F.sum("copies")).first()[0]
    assert total == 1000


def test_poisson_draws(spark):
    r = spark.range(40000).select(poisson_one(uniform(F.col("id"), "x")).alias("w")).agg(F.avg("w"), F.var_samp("w"), F.max("w")).first()
    assert abs(r[0] - 1) < 0.02 and abs(r[1] - 1) < 0.04 and r[2] <= 8


def test_bernoulli_draw(spark):
    n = sp.draw_poisson(spark.range(10000).toDF("k"), "k", F.lit(0.1), [0, 1]).groupBy("seed").count().collect()
    assert all(900 < r["count"] < 1100 for r in n)

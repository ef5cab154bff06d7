import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import ranks as rk


def digest(salt, key):
    return hashlib.md5(f"{salt}:{key}".encode()).hexdigest()


def in_order(keys, salt="s"):
    return sorted(keys, key=lambda k: (digest(salt, k), k))


def uniform(text):
    return int(digest("rank", text)[:13], 16) / 2**52


def drawn(n, seed, total):
    """Plain draw of n different ranks: try after try, or of those left out beyond a half."""
    m = n if 2 * n <= total else total - n
    seen = []
    for j in range(2 * m + 64):
        at = int(uniform(f"{seed}:{j}") * total)
        if at not in seen and len(seen) < m:
            seen.append(at)
    if 2 * n <= total:
        return seen
    return sorted(set(range(total)) - set(seen), key=lambda at: (uniform(f"order:{seed}:{at}"), at))


@pytest.mark.parametrize("per_part", [64, 1 << 20])
def test_every_rank_has_its_key(spark, per_part):
    keys = list(range(500)) + [7] * 300 + [9] * 16 + [11] * 2 + [13] * 20
    df = spark.createDataFrame([(k, "x") for k in keys], "k int, first string").repartition(5)
    ranks = rk.rank_directory(df, "k", "s", per_part=per_part)
    assert ranks.total == len(keys) and len(ranks.starts) == (1 if per_part > 500 else 8)
    got = ranks.look_up(spark.range(-3, len(keys) + 3).withColumnRenamed("id", "at")).collect()
    assert [r.k for r in sorted(got, key=lambda r: r["at"])] == in_order(keys)


def test_a_hot_key_is_one_row_of_the_directory(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    ranks = rk.rank_directory(df, "k", "s")
    assert ranks.rows.where("k = -1").select("k", "first", "n").distinct().count() == 1
    assert ranks.rows.count() <= 20001 + 1


@pytest.mark.parametrize("total, n", [(1000, 60), (100, 50), (100, 51), (100, 99), (40, 60), (1, 1)])
def test_draws_equal_the_plain_ones(spark, total, n):
    ranks = rk.rank_directory(spark.range(total).toDF("k"), "k", "s")
    order = in_order(range(total))
    for seed in (0, 3):
        rows = rk.draw_by_rank(ranks, n, [seed]).orderBy("place").collect()
        assert [r.k for r in rows] == [order[at] for at in drawn(min(n, total), seed, total)]
        assert [r.place for r in rows] == list(range(1, min(n, total) + 1))


def test_rows_of_one_key_are_drawn_as_rows(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [(None,)] * 9, "k string")
    rows = rk.draw_by_rank(rk.rank_directory(df, "k", "s"), 90, [0, 1]).collect()
    assert Counter((r.seed, r.k) for r in rows) == {(s, k): n for s in (0, 1) for k, n in (("a", 60), ("b", 30))}


def test_empty_table(spark):
    ranks = rk.rank_directory(spark.createDataFrame([], "k long"), "k", "s")
    assert ranks.total == 0 and rk.draw_by_rank(ranks, 5, [0, 1]).collect() == []


def test_only_parts_with_a_drawn_rank_are_read(spark):
    ranks = rk.rank_directory(spark.range(20000).toDF("k"), "k", "s", per_part=1000)
    plan = ranks.look_up(spark.range(1).withColumnRenamed("id", "at"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan

"""Running numbers, batches and alignment by position."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import ingest as ing, sampling as sp
from gaugeline.operators.numbering import running_number


@pytest.mark.parametrize("partitions", [1, 13])
def test_numbers_are_dense_and_in_order(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"), F.lit(5).alias("number")).repartition(6)
    got = running_number(df.select("id"), ["id"], "number", start=3, partitions=partitions).collect()
    assert sorted((r["id"], r["number"]) for r in got) == [(i, i + 3) for i in range(1000)]
    down = running_number(df.select("id"), [F.desc("id")], partitions=partitions).collect()
    assert all(r["number"] == 999 - r["id"] for r in down)


def test_equal_keys_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), ("b", 4), (None, 5), ("b", 6)], "k string, v int")
    got = sorted((r["n"], r["k"]) for r in running_number(df, ["k", "v"], "n", partitions=4).collect())
    assert got == [(0, None), (1, None), (2, "a"), (3, "b"), (4, "b"), (5, "b")]
    assert running_number(df.limit(0), ["k"]).collect() == []


def test_batches_are_full_but_the_last(spark):
    df = spark.range(205).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = sp.batches(df, "k", 20, partitions=9).collect()
    sizes = {}
    for r in got:
        sizes[r["batch"]] = sizes.get(r["batch"], 0) + 1
    assert sizes == {**{b: 20 for b in range(10)}, 10: 5}
    order = sorted(got, key=lambda r: r["batch"])
    assert all(max(x["k"] for x in got if x["batch"] == b) <= min(x["k"] for x in got if x["batch"] == b + 1) for b in range(10)) and len(order) == 205


def test_alignment_by_position(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "w")], "k int, v string")
    b = spark.createDataFrame([(10, "x"), (20, "z"), (30, None)], "at int, v string")
    r = ing.alignment_by_position(a.repartition(3), b, ["k"], ["at"], "v").first()
    assert tuple(r) == (1, 0, 1, 1, 4)
    assert tuple(ing.alignment_by_position(a, a, ["k"], ["k"], "v").first()) == (0, 0, 0, None, 4)

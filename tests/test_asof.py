"""As-of join against looking at every version."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.asof import as_of_join

T0 = datetime(2024, 1, 1)
FACTS, VERSIONS = "id int, who string, ts timestamp_ntz, name int", "start timestamp_ntz, who string, version string, n int"


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def brute(facts, versions, by):
    out = {}
    for i, who, ts, _ in facts:
        live = [(s, v, n) for s, w, v, n in versions if s is not None and ts is not None and s <= ts and (not by or w == who)]
        out[i] = max(live)[1:] if live else (None, None)
    return out


def run(spark, facts, versions, by, partitions):
    f = spark.createDataFrame([(i, w, at(t), x) for i, w, t, x in facts], FACTS)
    v = spark.createDataFrame([(at(s), w, name, n) for s, w, name, n in versions], VERSIONS)
    got = as_of_join(f, v, "ts", "start", ["version", "n"], by, partitions)
    assert got.columns == ["id", "who", "ts", "name", "version", "n"]
    rows = got.collect()
    assert len(rows) == len(facts)
    return {r["id"]: (r["version"], r["n"]) for r in rows}


@pytest.mark.parametrize("by", [[], ["who"]])
@pytest.mark.parametrize("partitions", [1, 9])
def test_against_every_version(spark, by, partitions):
    rng = random.Random(len(by) + partitions)
    facts = [(i, rng.choice(["a", "b", None, "c\""]), rng.choice([None, *range(0, 400, 7)]), 1) for i in range(300)]
    versions = [(rng.choice([None, *range(-20, 420, 5)]), rng.choice(["a", "b", None, "only"]), f"v{k}", k) for k in range(40)]
    assert run(spark, facts, versions, by, partitions) == brute(facts, versions, by)


@pytest.mark.parametrize("by", [[], ["who"]])
def test_all_facts_at_one_instant(spark, by):
    """One day, one instant, one key: the facts fall into many ranges, and most of these hold no version."""
    facts = [(i, "a", 60, 1) for i in range(2000)]
    versions = [(0, "a", "old", 1), (60, "a", "now", 2), (61, "a", "next", 3), (60, "b", "other", 9)]
    assert set(run(spark, facts, versions, by, 8).values()) == {("other", 9) if not by else ("now", 2)}


def test_long_gaps_between_versions(spark):
    facts = [(i, "a", i, 1) for i in range(1000)]
    versions = [(10, "a", "first", 1), (990, "a", "last", 2)]
    assert run(spark, facts, versions, [], 16) == brute(facts, versions, [])


def test_keys_do_not_leak_into_each_other(spark):
    facts = [(i, w, t, 1) for i, (w, t) in enumerate((w, t) for w in "abcdef" for t in range(0, 50, 5))]
    versions = [(20, "a", "a20", 1), (0, "c", "c0", 2), (49, "e", "e49", 3)]
    assert run(spark, facts, versions, ["who"], 12) == brute(facts, versions, ["who"])


def test_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(4)
        facts = [(i, rng.choice("ab"), rng.randrange(200), 1) for i in range(200)]
        versions = [(rng.randrange(200), rng.choice("ab"), f"v{k}", k) for k in range(9)]
        assert run(spark, facts, versions, ["who"], 3) == brute(facts, versions, ["who"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_sides(spark):
    facts = [(1, "a", 5, 1)]
    assert run(spark, facts, [], [], 4) == {1: (None, None)}
    assert run(spark, [], [(0, "a", "v", 1)], [], 4) == {}


def test_other_times(spark):
    f = spark.createDataFrame([(1, 10), (2, 3)], "id int, t int")
    v = spark.createDataFrame([(4, "x"), (11, "y")], "s int, v string")
    assert sorted(tuple(r) for r in as_of_join(f.withColumn("t", F.col("t")), v, "t", "s", ["v"]).collect()) == [(1, 10, "x"), (2, 3, None)]

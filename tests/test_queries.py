"""Every registered query against its SQL twin, and under other partitionings."""

import pytest

import __spark_entry__ as entry_points
import check
from gaugeline.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, note = check.compare(spark, con, name, FOLDER)
    assert status != "FAIL", note


@pytest.mark.parametrize("name", [
    "classification_report", "resample_spread", "bootstrap_ci", "nearest_example", "verbosity_curve", "multiple_tests", "linear_score",
])
def test_partitioning_does_not_matter(spark, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            status, note = check.compare(spark, con, name, FOLDER)
            assert status == "ok", note
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert set(df.columns) == {"class", "tp", "fp", "fn", "precision", "recall", "f1", "support"} and df.count() == 4


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())

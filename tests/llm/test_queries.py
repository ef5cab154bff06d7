"""Every registered training-data query: against its SQL where there is one, and for a stable result elsewhere."""

import pytest

import __spark_entry__ as entry_points
import check
from gaugeline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle(FOLDER)


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, note = check.compare(spark, con, name, FOLDER)
    assert status == ("ok" if name in ORACLES else "rows"), note


@pytest.mark.parametrize("name", ["op1_pfair_mix", "op3_quality_classifier", "op5_quartile_fingerprints", "op7_katz_backoff", "op8_minhash_near_dedup"])
def test_partitioning_does_not_matter(spark, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").repartition(5, "doc_id").write.parquet(f"{tmp_path}/{t}.parquet")

    def rows(folder):
        df = QUERIES[name](spark, folder)
        return check.canon(df.columns, [tuple(r) for r in df.collect()])

    whole = rows(FOLDER)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert rows(str(tmp_path)) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

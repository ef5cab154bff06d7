"""WARC records and the audit of replicas."""

import hashlib

from pyspark.sql import functions as F

from gaugeline.llm import fixity as fx
from gaugeline.sources.tables import table


def rows_of(found):
    return sorted((r.file, r.seq, r.damage) for r in found.collect())


def test_records_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a/é", "<p>é\r\n\r\nx</p>", 9), (2, None, None, 9), (None, "u\nv", "", 9), (1, "http://a/é", "<p>é\r\n\r\nx</p>", 9), (3, "v", "y" * 200_000, 9)],
                                  "page_id long, url string, html string, size int")
    records = fx.to_warc(pages, 1000).cache()
    assert records.count() == 5
    back = records.select("page_id", *[c.alias(n) for n, c in fx.read_record(F.col("record")).items()]).collect()
    want = [(1, "http://a/é", "<p>é\r\n\r\nx</p>"), (2, "", ""), (None, "u v", ""), (1, "http://a/é", "<p>é\r\n\r\nx</p>"), (3, "v", "y" * 200_000)]
    assert sorted((tuple(r) for r in back), key=str) == sorted(want, key=str)
    for _, g in records.toPandas().groupby("file"):
        at = 0
        for r in g.sort_values("seq").itertuples():
            assert (r.start, r.stop) == (at, at + len(r.record))
            at = r.stop


def test_audit_finds_every_damage(spark):
    records = fx.to_warc(table(spark, "/root/testdata/sf0.01", "pages"), 1 << 17).cache()
    files = records.groupBy("file").count().orderBy("file").collect()
    assert len(files) > 2 and max(r["count"] for r in files) > fx.FAN
    assert fx.audit(records, records).count() == 0
    lost = F.col("seq") % 23 == 5
    cut = F.col("seq") % 19 == 3
    moved = (F.col("seq") == 7) & (F.col("file") == files[0].file)
    replica = records.where(~lost).where(F.col("file") != files[1].file).withColumn("record", F.when(cut, F.lit(b"")).otherwise(F.col("record"))).withColumn(
        "stop", F.when(moved, F.col("stop") + 1).otherwise(F.col("stop")))
    want = []
    for r in records.select("file", "seq").collect():
        if r.file == files[1].file or r.seq % 23 == 5:
            want.append((r.file, r.seq, "missing"))
        elif r.seq % 19 == 3 or (r.seq == 7 and r.file == files[0].file):
            want.append((r.file, r.seq, "changed"))
    assert rows_of(fx.audit(records, replica)) == sorted(want)
    assert rows_of(fx.audit(replica, records)) == sorted((f, s, "extra" if d == "missing" else d) for f, s, d in want)


def test_root_covers_hashes_and_offsets(spark):
    rows = [(0, i, i * 10, i * 10 + 10, bytes([i])) for i in range(40)]
    leaves = fx.leaves(spark.createDataFrame(rows, "file long, seq long, start long, stop long, record binary"))
    levels = fx.hash_tree(leaves, 2)
    assert [x.count() for x in levels] == [40, 3, 1]

    def node(lines):
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()

    low = [f"{i}:{i * 10}:{i * 10 + 10}:{hashlib.sha256(bytes([i])).hexdigest()}" for i in range(40)]
    mid = [f"{k}:{k * 160}:{min(400, k * 160 + 160)}:{node(low[16 * k:16 * k + 16])}" for k in range(3)]
    assert levels[2].first().hash == node(mid)


def test_empty_and_null(spark):
    none = fx.to_warc(spark.createDataFrame([], "page_id long, url string, html string"))
    assert none.count() == 0 and fx.audit(none, none).count() == 0
    one = spark.createDataFrame([(0, 0, None, None, None)], "file long, seq long, start long, stop long, record binary")
    assert fx.audit(one, one).count() == 0 and rows_of(fx.audit(one, one.limit(0))) == [(0, 0, "missing")]

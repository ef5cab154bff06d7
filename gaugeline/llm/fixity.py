"""WARC records and a Merkle fixity audit of replicas.

``to_warc`` writes pages as WARC/1.0 records in files of about ``file_bytes`` and gives each record its byte range.
``leaves`` and ``hash_tree`` hash the records of every file and then ordered ranges of ``FAN`` neighbours, level by level up to one
root a file; a range's hash covers the offsets and hashes below it.  ``audit`` compares the roots of two replicas and
goes down only below ranges that differ, so the work beneath the roots grows with the damage.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, Window

from gaugeline.sources.tables import stored

FAN = 16
FILE_BYTES = 4 << 20


def to_warc(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Records (file, seq, page_id, start, stop, record): the bytes of a WARC/1.0 resource record for every page.

    Records are dealt into files by their digest, as many files as their bytes need, and ordered there by page_id and digest.  A null html or url is written as empty, a null page_id as an empty id.  Repeated rows are
    records of their own.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    body = F.encode(html, "UTF-8")
    page_id = F.col("page_id").cast("long")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", " "),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    df = pages.select(page_id.alias("page_id"), F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8")).alias("record"))
    total = df.agg(F.sum(F.octet_length("record"))).first()[0] or 0
    files = 1 + total // file_bytes
    df = df.withColumn("size", F.octet_length("record").cast("long")).withColumn("digest", F.md5("record"))
    df = df.withColumn("file", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % files)
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    stop = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.select("file", (F.row_number().over(order) - 1).cast("long").alias("seq"), "page_id", (stop - F.col("size")).alias("start"), stop.alias("stop"), "record")


def read_record(record) -> dict:
    """Columns that parse a record: its header block and its body, cut by Content-Length."""
    text = F.decode(record, "UTF-8")
    head = F.substring_index(text, "\r\n\r\n", 1)
    length = F.regexp_extract(head, r"Content-Length: (\d+)", 1).cast("int")
    start = F.octet_length(head) + 5
    return {"url": F.regexp_extract(head, r"WARC-Target-URI: ([^\r\n]*)", 1), "html": F.decode(F.substring(record, start, length), "UTF-8")}


def leaves(records: DataFrame) -> DataFrame:
    """Level 0 of a tree, one node a record.  Needs file, seq, start, stop, record; a null record counts as empty."""
    own = F.sha2(F.coalesce("record", F.lit(b"").cast("binary")), 256)
    return stored(records.select("file", F.col("seq").alias("node"), "start", "stop", own.alias("hash")), "leaves")


def hash_tree(bottom: DataFrame, height: int) -> list[DataFrame]:
    """Levels (file, node, start, stop, hash) from the leaves up; ``height`` levels above them."""
    levels = [bottom]
    for _ in range(height):
        below = levels[-1].withColumn("up", F.floor(F.col("node") / FAN))
        line = F.concat_ws(":", "node", F.coalesce(F.col("start").cast("string"), F.lit("-")), F.coalesce(F.col("stop").cast("string"), F.lit("-")), "hash")
        parts = F.array_sort(F.collect_list(F.struct("node", line.alias("line"))))  # FAN children, more only where records are repeated
        up = below.groupBy("file", "up").agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                                             F.sha2(F.array_join(F.transform(parts, lambda p: p["line"]), "\n"), 256).alias("hash"))
        levels.append(stored(up.withColumnRenamed("up", "node"), "level"))
    return levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records that differ between two replicas: file, seq, start, stop, hash, other_start, other_stop, other_hash, damage.

    ``left`` and ``right`` are tables of file, seq, start, stop, record.  ``damage`` is changed (bytes or place), missing
    (only on the left) or extra (only on the right).  A file that one replica lacks comes out whole, equal replicas give no
    row.  (file, seq) is expected to be unique; repeated ones are hashed together and compared pairwise at the bottom.
    """
    a, b = leaves(left), leaves(right)
    most = a.select("node").unionByName(b.select("node")).agg(F.max("node")).first()[0] or 0
    height = 0
    while most > 0:
        most //= FAN
        height += 1
    differ = None
    for level, (x, y) in reversed(list(enumerate(zip(hash_tree(a, height), hash_tree(b, height))))):
        if differ is not None:
            x, y = (t.withColumn("up", F.floor(F.col("node") / FAN)).join(differ, ["file", "up"], "left_semi") for t in (x, y))
        x = x.select("file", "node", "start", "stop", "hash")
        y = y.select("file", "node", *[F.col(c).alias(f"other_{c}") for c in ("start", "stop", "hash")])
        same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in ("start", "stop", "hash")])
        found = x.join(y, ["file", "node"], "full").where(~same)
        differ = stored(found.select("file", F.col("node").alias("up")).distinct(), "differ") if level else found
    damage = F.when(F.col("other_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("changed")
    return differ.withColumnRenamed("node", "seq").withColumn("damage", damage)

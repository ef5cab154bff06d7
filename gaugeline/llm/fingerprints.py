"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every run of five bytes counts six hashed triplets into 256 buckets.  Each bucket is encoded by the
quartile of the text's own counts it falls into (two bits), after a checksum byte, the logarithm of
the length and the ratios of the quartiles.  Digests of similar texts differ in few buckets; the
difference of two digests is a bounded sum, which makes a likeness from 0 to 1.

``next_documents`` gives each row its neighbour in descending doc_id order without a global sort in
one task: rows go to ranges of doc_id, and the first row of each range is also sent to the range before it.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from gaugeline.llm.workers import importable

BUCKETS = 256
#: Offsets of the triplets in a run of five bytes, newest first.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
RATIO_WEIGHT, LENGTH_WEIGHT, LENGTH_MOST, FAR = 4, 4, 12, 6
#: Largest difference of two digests: each bucket FAR, two ratios of 0..15, a length, the checksum.
MOST = BUCKETS * FAR + 2 * 15 * RATIO_WEIGHT + LENGTH_MOST * LENGTH_WEIGHT + 1
_rng = np.random.Generator(np.random.PCG64(11))
#: One scrambled 16-bit table for each triplet and place; the sum's high byte is the bucket.
TABLES = _rng.integers(0, 1 << 16, (len(TRIPLETS), 3, 256), dtype=np.uint16)
RANGE_ROWS, COARSE, FINE = 5_000, 1024, 64


def counts(data: np.ndarray) -> np.ndarray:
    """Bucket counts of all triplets."""
    out = np.zeros(BUCKETS, np.int64)
    n = len(data) - 4
    if n <= 0:
        return out
    at = [data[4 - k:4 - k + n] for k in range(5)]
    for table, (a, b, c) in zip(TABLES, TRIPLETS):
        out += np.bincount((table[0][at[a]] + table[1][at[b]] + table[2][at[c]]) >> np.uint16(8), minlength=BUCKETS)
    return out


def digest(text: bytes) -> bytes:
    """2 + 1 + 64 bytes: checksum, length, ratios, two bits a bucket.  A text under five bytes has no triplet."""
    count = np.zeros(BUCKETS, np.int64)
    for a in range(0, max(1, len(text) - 4), 1 << 20):  # pieces bound the memory of a long text
        count += counts(np.frombuffer(text[a:a + (1 << 20) + 4], np.uint8))
    ranked = np.sort(count)
    q = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = ((count > q[0]).astype(np.uint8) + (count > q[1]) + (count > q[2]))
    top = max(int(q[2]), 1)
    ratios = (int(q[0]) * 100 // top) % 16 << 4 | (int(q[1]) * 100 // top) % 16
    length = min(255, int(round(np.log(len(text) + 1) / np.log(1.1))))
    packed = code.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)
    return hashlib.md5(text).digest()[:1] + bytes([length, ratios]) + packed.sum(axis=1).astype(np.uint8).tobytes()


def _codes(d: bytes) -> np.ndarray:
    packed = np.frombuffer(d, np.uint8, offset=3)
    return ((packed[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).reshape(-1).astype(np.int64)


def difference(a: bytes, b: bytes) -> int:
    """Bounded difference score of two digests, 0 for equal ones, at most ``MOST``."""
    apart = np.abs(_codes(a) - _codes(b))
    total = int(np.where(apart == 3, FAR, apart).sum()) + (a[0] != b[0])
    total += min(LENGTH_MOST, abs(a[1] - b[1])) * LENGTH_WEIGHT
    for shift in (4, 0):
        d = abs((a[2] >> shift & 15) - (b[2] >> shift & 15))
        total += min(d, 16 - d) * RATIO_WEIGHT
    return total


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / MOST


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) first ones of another text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def in_ranges(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of descending doc_id, each with the first row of the range after it at its end.

    ``COARSE`` ranges at most are cut at quantiles of doc_id, each into up to ``FINE`` of equal width, one range for each
    ``RANGE_ROWS`` rows.  Equal ids never part.  A null doc_id comes after all others.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n, low, high = base.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        low = high = 0
    coarse = min(COARSE, max(1, n // RANGE_ROWS))
    fine = min(FINE, max(1, n // RANGE_ROWS // coarse))
    marks = base.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / coarse for i in range(1, coarse)], 1 / (20 * coarse)) if coarse > 1 else []
    bounds = sorted({int(m) for m in marks if low < m <= high}, reverse=True)
    # coarse range r holds the ids below bound r - 1, down to bound r
    row, to_array = F.col("doc_id"), lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    r = F.size(F.filter(to_array(bounds), lambda b: b > row)) if bounds else F.lit(0)
    top, bottom = F.get(to_array([high, *bounds]), r).cast("double"), F.get(to_array([*bounds, low]), r).cast("double")
    inside = F.least(F.lit(fine - 1), F.floor(F.coalesce((top - row.cast("double")) / F.nullif(top - bottom, F.lit(0.0)), F.lit(0.0)) * fine))
    part = F.when(row.isNull(), F.lit((len(bounds) + 1) * fine)).otherwise(r * fine + inside).cast("long")
    base = base.withColumn("part", part)
    heads = {x.part: x.head for x in base.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}  # COARSE * FINE + 1 rows at most
    order = sorted(heads)
    known = spark.createDataFrame([(p, heads[p], order[i - 1]) for i, p in enumerate(order)], "part long, head long, above long")
    own, late = F.struct("part", F.lit(0).alias("late")), F.struct(F.col("above").alias("part"), F.lit(1).alias("late"))
    to = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, late)).otherwise(F.array(own))
    return base.join(F.broadcast(known), "part").select("doc_id", "text", F.explode(to).alias("to")).select("doc_id", "text", "to.part", "to.late")


def _rows(batches):
    """Yield (part, late, doc_id, text) in order."""
    for batch in batches:
        yield from zip(batch.column("part").to_pylist(), batch.column("late").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"))


def _pairs(batches):
    """Yield (row, next row) inside each range."""
    before = None
    for row in _rows(batches):
        if before is not None and before[0] == row[0] and not before[1]:
            yield before, row
        before = row


def _score(batches):
    out, seen = [], [None, None]
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    for (_, _, doc_id, text), (_, _, _, following) in _pairs(batches):
        text, following = text.as_py(), following.as_py()
        raw = text.encode()
        own = seen[1] if seen[0] == text else digest(raw)
        after = digest(following.encode())
        seen = [following, after]
        changed = edited(text, following).encode()
        print_ = digest(changed)
        out.append((doc_id, len(text), hashlib.sha256(changed).hexdigest(), own.hex(), print_.hex(), likeness(own, print_), likeness(own, after)))
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after in descending doc_id, the first one after the last; a null doc_id comes last, rows
    of one doc_id are ordered by their text.  A single row is its own neighbour.  A null text is empty; all texts under five
    bytes have the same bucket codes.  Equal texts have equal fingerprints.  Other columns are ignored.
    """
    placed = in_ranges(importable(docs))
    parts = max(1, placed.sparkSession.sparkContext.defaultParallelism, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartition(parts, "part").sortWithinPartitions("part", "late", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.mapInArrow(_score, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

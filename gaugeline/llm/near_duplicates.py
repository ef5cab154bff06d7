"""MinHash near-duplicates by min-max hashing, confirmed on full shingle sets.

1. One pass over the texts gives every document its shingle count, a 128-bit digest of its
   shingle set, and a signature: under each of 64 hash functions the least and the greatest
   value, 128 values from 64 evaluations.  Both extremes agree with probability J, so the
   signature is unbiased with less variance than 64 minima.
2. Equal sets form a class with a number of its own; only one text of it goes on, under that number, so a doc_id
   with several texts, or none, loses nothing.
3. 32 bands of 4 values put documents into buckets.  A pair of similarity 0.80 misses all of
   them with probability (1 - 0.80^4)^32 = 5e-8, one of 0.85 with 6e-11.  Inside a bucket the signatures
   (a byte of each value) are compared in numpy; a pair that agrees in fewer than 72 of 128 bytes has a
   similarity of 0.80 with probability below 1e-9 and is left out.  What is left falls into
   families, the connected components of the possible links.
4. The texts of a family meet in one task (large families in several, see ``_confirmed``) and
   the links are found on the full sets.  Each task returns its components as stars, at most
   one row per document and never a row per pair.
5. Components of all links; the classes' doc_ids are joined at the end.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm import words as W
from gaugeline.llm.components import components
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import discard, stored

SIZE = 5
FUNCTIONS, BAND = 64, 4
LEAST_BYTES = 72
SMALL = 128
BLOCK, BLOCK_BYTES = 1024, 8 << 20
_rng = np.random.Generator(np.random.PCG64(7))
ODD = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)


def text_shingles(column: pa.Array):
    """Yield (first row, number of rows, text index, hash) of the distinct shingles, sorted by text and hash."""
    for at, data, bounds in W.pieces(column):
        word, text, _, _ = W.words(data, bounds)
        h, owner = W.shingles(word, text, len(bounds) - 1, SIZE)
        owner, h = W.distinct(owner, h)
        yield at, len(bounds) - 1, owner, h


def _signatures(batches):
    for batch in batches:
        for at, n, owner, h in text_shingles(batch.column(1)):
            count = np.bincount(owner, minlength=n)
            has = np.flatnonzero(count)
            digest, sign, bands = np.zeros((n, 2), np.uint64), np.zeros((n, 2 * FUNCTIONS), np.uint8), np.zeros((n, 2 * FUNCTIONS // BAND), np.uint64)
            if len(has):
                first = (np.cumsum(count) - count)[has]
                values = np.empty((2 * FUNCTIONS, len(has)), np.uint64)
                for i in range(FUNCTIONS):
                    v = W.mix(h * ODD[i] + ADD[i]) if i < 1 else h * ODD[i] + ADD[i]
                    values[2 * i] = np.minimum.reduceat(v, first)
                    values[2 * i + 1] = np.maximum.reduceat(v, first)
                for j, odd in enumerate((1, 3)):
                    digest[has, j] = np.add.reduceat(W.mix(h * W.LETTER[odd]), first)
                sign[has] = W.mix(values).astype(np.uint8).T
                for j in range(bands.shape[1]):
                    key = np.full(len(has), j + 1, np.uint64)
                    for v in values[j * BAND:(j + 1) * BAND]:
                        key = W.mix(key * W.BASE + v)
                    bands[has, j] = key
            keys = pa.array([bytes(x) for x in digest], pa.binary())
            per = bands.shape[1]
            yield pa.RecordBatch.from_arrays([
                *[c.slice(at, n) for i, c in enumerate(batch.columns) if i != 1], pa.array(count.astype(np.int64)), keys,
                pa.array([bytes(x) for x in sign], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, per * n + 1, per, dtype=np.int32)), pa.array(bands.reshape(-1).view(np.int64))),
            ], names=[*[c for c in batch.schema.names if c != "text"], "n_shingles", "set_key", "sign", "bands"])


def _root(parent: list, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _joined(n: int, first: int, linked_to, testers=None) -> np.ndarray:
    """Component of each of n members.  ``linked_to(i)`` says which members link with i.

    Starts from one member.  A member of the largest component needs no test of its own
    once all members outside have been tested against everyone.  If ``testers`` are given,
    exactly these are tested.
    """
    parent = list(range(n))
    tested = np.zeros(n, bool)

    def test(i):
        tested[i] = True
        for j in np.flatnonzero(linked_to(i)):
            a, b = _root(parent, i), _root(parent, int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)

    for i in [first] if testers is None else testers:
        test(int(i))
    while True:
        label = np.array([_root(parent, i) for i in range(n)])
        sizes = np.bincount(label, minlength=n)
        left = np.flatnonzero((label != np.argmax(sizes)) & ~tested)
        if testers is not None or not len(left):
            return label
        for i in left:
            test(int(i))


def _stars(ids: np.ndarray, label: np.ndarray):
    """(member, least member of its component) for all members that are not alone."""
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    size = np.bincount(label, minlength=len(ids))
    has = size[label] > 1
    return ids[has], least[label][has]


def _links(us: list, vs: list) -> pa.RecordBatch:
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us or none)), pa.array(np.concatenate(vs or none))], names=["u", "v"])


def _small_buckets(batches):
    """Possible links inside small buckets, one row each, from signatures."""
    for batch in batches:
        us, vs = [], []
        for members in batch.column(0).to_pylist():
            ids = np.array([m["node"] for m in members], np.int64)
            sign = np.frombuffer(b"".join(m["sign"] for m in members), np.uint8).reshape(len(ids), -1)
            u, v = _stars(ids, _joined(len(ids), int(np.argmin(ids)), lambda i, sign=sign: (sign == sign[i]).sum(axis=1) >= LEAST_BYTES))
            us.append(u)
            vs.append(v)
        yield _links(us, vs)


def _confirmer(percent: int):
    """Links on full sets in one block of families; rows of side 1 are only tested against those of side 0 and 2."""

    def confirm(table: pa.Table) -> pa.Table:
        table = table.sort_by([("family", "ascending"), ("node", "ascending")])
        ids, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for at, _, owner, h in text_shingles(table.column("text")):
            owners.append(owner + at)
            found.append(h)
        owner, h = np.concatenate(owners), np.concatenate(found)
        cut = np.flatnonzero(np.diff(table.column("family").to_numpy())) + 1
        size_of = np.bincount(owner, minlength=len(ids))
        at = np.concatenate([[0], np.cumsum(size_of)])
        us, vs = [], []
        for a, b in zip([0, *cut], [*cut, len(ids)]):
            label = _family(h[at[a]:at[b]], size_of[a:b], side[a:b], percent)
            u, v = _stars(ids[a:b], label)
            us.append(u)
            vs.append(v)
        return pa.table(_links(us, vs).to_pydict(), schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return confirm


def _family(h: np.ndarray, size: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    names, local = np.unique(h, return_inverse=True)
    start = np.cumsum(size) - size
    mark = np.zeros(len(names), np.int64)
    has = np.flatnonzero(size)

    def linked_to(i):
        out = np.zeros(len(size), bool)
        own = local[start[i]:start[i] + size[i]]
        if len(own):
            mark[own] = 1
            both = np.add.reduceat(mark[local], start[has])
            mark[own] = 0
            out[has] = 100 * both >= percent * (size[has] + size[i] - both)
        return out

    shared = np.flatnonzero(side == 2)
    testers = np.flatnonzero(side == 0) if (side == 1).any() else None
    return _joined(len(size), int(shared[0]) if len(shared) else 0, linked_to, testers)


def _possible_links(signs: DataFrame) -> DataFrame:
    """Stars of possible links over all buckets.  The members of a large bucket count as one family: a row each."""
    at = signs.select("node", F.explode("bands").alias("bucket"))
    sizes = at.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    near = at.join(sizes, "bucket")
    large = near.where(f"n > {SMALL} AND node > least").select(F.col("node").alias("u"), F.col("least").alias("v"))
    small = (near.where(f"n <= {SMALL}").join(signs.select("node", "sign"), "node").groupBy("bucket")
             .agg(F.collect_list(F.struct("node", "sign")).alias("members")).select("members"))
    return small.mapInArrow(_small_buckets, "u long, v long").unionByName(large).distinct()


def grouped(docs: DataFrame, percent: int = 80, keep=()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, group and the ``keep`` columns.

    ``group`` numbers the components of all rows, those without a doc_id included; it is null without a shingle.  The
    numbers change from run to run.  For the rest see ``link_components``.
    """
    held = [F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)]
    base = importable(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *held)
    base = base.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "doc_id", "text"))
    passed = ", ".join(f"{n} {t}" for n, t in base.dtypes if n != "text")
    signs = stored(base.mapInArrow(_signatures, f"{passed}, n_shingles long, set_key binary, sign binary, bands array<long>"), "signs")
    filled = signs.where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("rep")
    classes = stored(filled.groupBy("set_key").agg(least).select("set_key", "rep.doc_id", "rep.k1", "rep.k2", F.monotonically_increasing_id().alias("node")), "classes")
    reps = filled.select("k1", "k2", "sign", "bands").join(classes.select("k1", "k2", "node"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    possible = stored(_possible_links(reps), "possible")
    family = stored(components(possible), "families")
    spent = [possible, family]
    links = stored(_confirmed(base, classes, family, percent, spent), "confirmed")
    for t in spent:
        discard(t)
    own = components(links)
    known = classes.join(own, "node", "left").select("set_key", "doc_id", F.coalesce("component", "node").alias("group"))
    known = stored(known, "known")
    known = known.join(known.groupBy("group").agg(F.min("doc_id").alias("least")), "group").select("set_key", "group", "least")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    out = signs.join(known, "set_key", "left").withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group",
                      *[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)])


def link_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents link when 100 * |intersection| >= percent * |union| of their distinct 5-word
    shingles; ``percent`` has to be 80 or more for the stated error rates.  Words are lower-cased
    (A-Z) and separated by blanks.  Null, empty and blank texts have no shingle and link with nothing; a long text is
    taken whole.  Every row is a document: rows of one doc_id with different texts have links of their own, and component_id is the
    least doc_id that a row's text reaches, so repeated rows and ties between unequal texts come out alike in any order.
    A row without a doc_id links like any other: its component is the least doc_id it reaches, null and kept if there is none.
    Other columns are ignored, whatever their names.  An empty table gives no rows.
    """
    return grouped(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _confirmed(base: DataFrame, classes: DataFrame, family: DataFrame, percent: int, spent: list) -> DataFrame:
    """Stars of confirmed links; ``spent`` gets the tables that aren't needed once they are written.

    Small families share blocks.  A family of more than ``BLOCK`` members or ``BLOCK_BYTES`` of text is
    dealt into blocks by a hash.  First each block is joined up on its own together with one common
    member, which usually unites the bulk.  Then only the members outside the family's largest
    component are compared with the other blocks, so a group of n copies costs n rows and not n^2.
    """
    asked = classes.join(family.select("node", F.col("component").alias("family")), "node").select("k1", "k2", "node", "family")
    texts = stored(base.select("text", "k1", "k2").join(asked, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("node", "text", "family"), "texts")
    sized = texts.groupBy("family").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min("node").alias("pivot"))
    sized = stored(sized.withColumn("q", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))), "sizes")
    bins = 1 + (sized.where("q = 1").agg(F.sum("bytes")).first()[0] or 0) // BLOCK_BYTES
    one = F.col("q") == 1
    dealt = (texts.join(sized.select("family", "q", "pivot"), "family")
             .withColumn("own", F.pmod(F.when(one, F.xxhash64("family")).otherwise(F.xxhash64("node", F.lit(1))), F.when(one, F.lit(bins)).otherwise(F.col("q"))))
             .withColumn("at", F.when(~one, F.col("family"))))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("q") - 1)
    confirm = _confirmer(percent)
    shared = (dealt.where("q > 1 AND node = pivot").withColumn("to", F.explode(numbers)).where("to <> own")
              .select("at", F.col("to").alias("own"), "family", "node", "text", F.lit(2).alias("side")))
    first = dealt.select("at", "own", "family", "node", "text", F.when((F.col("q") > 1) & (F.col("node") == F.col("pivot")), 2).otherwise(0).alias("side"))
    first = stored(first.unionByName(shared).groupBy("at", "own").applyInArrow(confirm, "u long, v long"), "first")
    spent += [texts, sized, first]
    if sized.where("q > 1").isEmpty():
        return first
    label = components(first).select("node", "component")
    many = dealt.where("q > 1").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    largest = (many.groupBy("family", "component").agg(F.count("*").alias("n"))
               .groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("main")))
    many = stored(many.join(largest, "family"), "large")
    spent.append(many)
    outside = many.where("component <> main")
    parts = outside.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    testers = (outside.join(parts, "family").withColumn("part", F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")))
               .withColumn("to", F.explode(numbers)).select("family", "part", "to", "node", "text", F.lit(0).alias("side")))
    others = (many.join(parts, "family").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .select("family", "part", F.col("own").alias("to"), "node", "text", F.lit(1).alias("side")))
    second = testers.unionByName(others).groupBy("family", "part", "to").applyInArrow(confirm, "u long, v long")
    return first.unionByName(second)

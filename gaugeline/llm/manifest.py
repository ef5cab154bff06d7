"""Merkle dataset manifest with bitmap-rank indexing.

Every row is a leaf; the leaves of a group (a source) stand in order of their id, every ``FAN`` neighbours make a node, and so
on up to the group's root; the groups' roots, in order of the group, make the root of the dataset likewise.

Leaves get their place without being sorted.  The ids of a group are a bitmap of 64-bit words, of which only those with a bit are kept;
above them are popcount directories of ``1 << span`` entries an entry, as many as the largest id needs.  The rank of an id is what the
directories count before its word, plus the popcount of the lower bits of that word.  Every window is one
directory entry's children, so a group that holds most rows is never one task's work.

Places address slots: the ``FAN ** levels`` leaves of a block meet in an array by their place and go up ``levels`` levels at once, as do the blocks' tops
in the next step.  Then every block gets the siblings above it, top down, and unfolds the proofs of its leaves.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from gaugeline.llm.workers import importable
from gaugeline.operators.numbering import running_number
from gaugeline.sources.tables import stored

FAN, LEVELS = 3, 6
SPAN = 10
#: What makes up a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(values) -> Column:
    """SHA-256 of the values one after the other: ``-`` for null, else length in UTF-8 bytes, ``:``, value."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def group_key(group: Column) -> Column:
    """A key that is never null and sorts as the groups do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def height(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def parent(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join(h.hex() for h in run).encode()).digest()


def reduce_levels(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([parent(out[-1][i:i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def path_of(levels: list[list[bytes]], place: int) -> bytes:
    """Siblings of a node level by level: a byte of its place in the run and their number, then their digests."""
    out = []
    for nodes in levels[:-1]:
        first = place - place % FAN
        run = nodes[first:first + FAN]
        at = place - first
        out.append(bytes([at | (len(run) - 1) << 2]) + b"".join(run[:at] + run[at + 1:]))
        place //= FAN
    return b"".join(out)


def steps_of(path: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(path):
        at, n = path[i] & 3, path[i] >> 2
        out.append((at, [path[i + 1 + 32 * j:i + 33 + 32 * j] for j in range(n)]))
        i += 1 + 32 * n
    return out


def fold(leaf: bytes, steps) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for at, siblings in steps:
        leaf = parent([*siblings[:at], leaf, *siblings[at:]])
    return leaf


def proof_hash(path: bytes) -> str:
    return hashlib.sha256("".join(s.hex() for _, siblings in steps_of(path) for s in siblings).encode()).hexdigest()


def rank_index(rows: DataFrame, span: int) -> tuple[DataFrame, DataFrame, int]:
    """(words, groups, first word) over the ids of ``__group, __id``.

    words: __group, __word, bits, repeated (position and copies of ids that occur more than once), before (rows of the group in
    earlier words).  groups: __group, n.  Null ids are a word of their own before the others.
    """
    first = rows.agg(F.min(F.shiftright("__id", 6))).first()[0] or 0
    entry = rows.groupBy("__group", word_of(first).alias("__word"), position().alias("__at")).agg(F.count("*").alias("c"))
    one = bit()
    more = F.collect_list(F.when(F.col("c") > 1, F.struct(F.col("__at").alias("at"), (F.col("c") - 1).alias("more"))))
    words = stored(entry.groupBy("__group", "__word").agg(F.bit_or(one).alias("bits"), more.alias("repeated"), F.sum("c").alias("n")), "bitmap")
    directory, last = [words], words.agg(F.max("__word")).first()[0] or 0
    while last or len(directory) == 1:
        below = directory[-1]
        directory.append(stored(below.groupBy("__group", F.shiftright("__word", span).alias("__word")).agg(F.sum("n").alias("n")), "directory"))
        last >>= span
    groups = directory[-1].select("__group", "n")
    before = directory[-1].select("__group", F.col("__word").alias("__up"), F.lit(0).cast("long").alias("__base"))
    for level in reversed(directory[:-1]):
        inside = Window.partitionBy("__group", "__up").orderBy("__word").rowsBetween(Window.unboundedPreceding, -1)  # at most 1 << span rows
        counted = level.withColumn("__up", F.shiftright("__word", span)).withColumn("__inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        based = counted.join(before, ["__group", "__up"]).withColumn("before", F.col("__inside") + F.col("__base"))
        if level is words:
            return stored(based.select("__group", "__word", "bits", "repeated", "before"), "ranks"), groups, first
        before = based.select("__group", F.col("__word").alias("__up"), F.col("before").alias("__base"))


def word_of(first: int) -> Column:
    return F.coalesce(F.shiftright("__id", 6) - F.lit(first) + 1, F.lit(0).cast("long"))


def bit(of: int = 1) -> Column:
    return F.call_function("shiftleft", F.lit(of).cast("long"), F.col("__at"))


def position() -> Column:
    return F.coalesce(F.col("__id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def coordinates(rows: DataFrame, span: int) -> DataFrame:
    """The rows (__group, __id, __leaf, __other) with __n, the rows of their group, and __place, their place in it from 0.

    Rows of one id stand in order of their leaves; equal rows are counted, not told apart.
    """
    words, groups, first = rank_index(rows, span)
    lower = F.col("bits").bitwiseAND(F.bitwise_not(bit(-1)))
    extra = F.aggregate(F.filter("repeated", lambda r: r["at"] < F.col("__at")), F.lit(0).cast("long"), lambda s, r: s + r["more"])
    rank = F.col("before") + F.bit_count(lower) + extra
    met = rows.withColumn("__word", word_of(first)).withColumn("__at", position()).join(words, ["__group", "__word"])
    again = F.exists("repeated", lambda r: r["at"] == F.col("__at"))
    met = met.select("__group", "__id", "__leaf", "__other", rank.alias("__place"), again.alias("__again"))
    single = met.where("NOT __again").drop("__again")
    versions = met.where("__again").groupBy("__group", "__id", "__leaf", "__other", "__place").agg(F.count("*").alias("c"))
    versions = versions.withColumn("__range", F.substring(F.hex("__leaf"), 1, 3))  # even ranges: leaves are digests
    ranges = versions.groupBy("__group", "__id", "__range").agg(F.sum("c").alias("c"))
    across = Window.partitionBy("__group", "__id").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    ranges = ranges.select("__group", "__id", "__range", F.coalesce(F.sum("c").over(across), F.lit(0)).alias("__base"))
    within = Window.partitionBy("__group", "__id", "__range").orderBy("__leaf", "__other").rowsBetween(Window.unboundedPreceding, -1)
    versions = versions.withColumn("__inside", F.coalesce(F.sum("c").over(within), F.lit(0)))
    same = F.col("v.__group").eqNullSafe(F.col("r.__group")) & F.col("v.__id").eqNullSafe(F.col("r.__id")) & (F.col("v.__range") == F.col("r.__range"))
    versions = versions.alias("v").join(ranges.alias("r"), same).select("v.*", "r.__base")
    copies = versions.select("__group", "__id", "__leaf", "__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("k"),
                             (F.col("__place") + F.col("__base") + F.col("__inside")).alias("__place"))
    repeated = copies.select("__group", "__id", "__leaf", "__other", (F.col("__place") + F.col("k")).alias("__place"))
    return single.unionByName(repeated).join(groups.withColumnRenamed("n", "__n"), "__group")


SLOTS = "__group string, __n long, __block long, top binary, ids array<long>, leaves binary, others binary"


def _slotter(levels: int):
    block = FAN ** levels

    def slots(table: pa.Table) -> pa.Table:
        """One block: its leaves by slot, and the node they reduce to."""
        n, place = table.column("__n")[0].as_py(), table.column("__place").to_numpy()
        slot = np.empty(len(place), np.int64)
        slot[place % block] = np.arange(len(place))
        table = table.take(pa.array(slot))
        leaves = table.column("__leaf").to_pylist()
        top = reduce_levels(leaves, min(levels, height(n)))[-1][0]
        return pa.table({
            "__group": table.column("__group").slice(0, 1), "__n": pa.array([n], pa.int64()), "__block": pa.array([int(place[0]) // block], pa.int64()),
            "top": pa.array([top], pa.binary()), "ids": pa.array([table.column("__id").to_pylist()], pa.list_(pa.int64())),
            "leaves": pa.array([b"".join(leaves)], pa.binary()), "others": pa.array([b"".join(table.column("__other").to_pylist())], pa.binary()),
        })

    return slots


def blocks_of(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of nodes (__group, __n, __place, __id, __leaf, __other)."""
    block = F.floor(F.col("__place") / FAN ** levels).cast("long")
    grouped = importable(nodes).select("__group", "__n", "__place", "__id", "__leaf", "__other", block.alias("__block")).groupBy("__group", "__block")
    return stored(grouped.applyInArrow(_slotter(levels), SLOTS), "slots")


def climb(nodes: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """Blocks of every step up to one top a group; ``most`` is the largest group's number of nodes."""
    block = FAN ** levels
    steps = [blocks_of(nodes, levels)]
    while most > block:
        most = -(-most // block)
        below = steps[-1].where(F.col("__n") > block)
        none = F.lit(None)
        steps.append(blocks_of(below.select("__group", F.ceil(F.col("__n") / block).cast("long").alias("__n"), F.col("__block").alias("__place"),
                                            none.cast("long").alias("__id"), F.col("top").alias("__leaf"), F.col("top").alias("__other")), levels))
    return steps


def tops(steps: list[DataFrame], levels: int) -> DataFrame:
    """__group and top of the groups' last blocks."""
    out = None
    for s in steps:
        last = s.where(F.col("__n") <= FAN ** levels).select("__group", "top")
        out = last if out is None else out.unionByName(last)
    return out


def _rows(batch):
    """One block at a time."""
    return (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch)))


PATHS = "__group string, __place long, path binary, subroot binary"


def _pather(levels: int):
    def paths(batches):
        """Every node of a block with its path up to the root."""
        for batch in batches:
            for row in _rows(batch):
                leaves = [row["leaves"][i:i + 32] for i in range(0, len(row["leaves"]), 32)]
                tree = reduce_levels(leaves, min(levels, height(row["__n"])))
                first = row["__block"] * FAN ** levels
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["__group"]] * len(leaves)), pa.array([first + i for i in range(len(leaves))], pa.int64()),
                    pa.array([path_of(tree, i) + row["path"] for i in range(len(leaves))], pa.binary()), pa.array([row["subroot"]] * len(leaves), pa.binary()),
                ], names=["__group", "__place", "path", "subroot"])

    return paths


def descend(steps: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """Blocks of the first step with ``path`` and ``subroot``; ``ends`` has them by __group for the last block of each group."""
    ends = ends.withColumn("__block", F.lit(0).cast("long"))
    above, block = None, FAN ** levels
    for k, s in reversed(list(enumerate(steps))):
        met = s.where(F.col("__n") <= block).join(ends, ["__group", "__block"])
        if above is not None:
            met = met.unionByName(s.where(F.col("__n") > block).join(above.withColumnRenamed("__place", "__block"), ["__group", "__block"]))
        if k == 0:
            return met
        above = stored(met.drop("ids", "others", "top").mapInArrow(_pather(levels), PATHS), "paths")


def _unfolder(root: bytes, levels: int, with_proof: bool):
    def unfold(batches):
        for batch in batches:
            for row in _rows(batch):
                cut = lambda b: [b[i:i + 32] for i in range(0, len(b), 32)]
                leaves, others = cut(row["leaves"]), cut(row["others"])
                tree = reduce_levels(leaves, min(levels, height(row["__n"])))
                paths = [path_of(tree, i) + row["path"] for i in range(len(leaves))]
                folded = [fold(other, steps_of(path)) for other, path in zip(others, paths)]
                n = len(leaves)
                arrays = [
                    pa.array([row["__group"]] * n), pa.array(row["ids"], pa.int64()), pa.array([row["__block"] * FAN ** levels + i for i in range(n)], pa.int64()),
                    pa.array([h.hex() for h in leaves]), pa.array([row["subroot"].hex()] * n), pa.array([root.hex()] * n),
                    pa.array([proof_hash(p) for p in paths]), pa.array([h.hex() for h in folded]), pa.array([h == root for h in folded]),
                ]
                names = ["__group", "__id", "place", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                if with_proof:
                    arrays.append(pa.array(paths, pa.binary()))
                    names.append("proof")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return unfold


def manifest(rows: DataFrame, id_: str = "doc_id", group: str = "source", leaf: str = "leaf", other: str = "other", with_proof: bool = False,
             levels: int = LEVELS, span: int = SPAN) -> DataFrame:
    """One row per row of ``rows``: its id and group, place (in its group, from 0), leaf, subroot, root, proof_sha256, folded_root, verified, and proof if wanted.

    ``leaf`` is the digest (32 bytes) that goes into the trees, ``other`` the digest that is folded up again with the leaf's siblings, such as that
    of the row in a replica.  A proof is a run of levels from the leaf to the root, read by ``steps_of``.  A group of one row has that row's leaf as its
    subroot, a dataset of one group that group's subroot as its root.

    Ids are whole numbers of any sign.  Rows of null id stand before the others of their group, rows of one id in order of their
    leaves; equal rows are leaves of their own.  A null group is a group of its own, before the empty one.  A null digest raises.
    An empty table gives no row.  Further columns of ``rows`` don't matter, whatever their names.  ``levels`` and ``span`` bound what a task holds and
    change no result.
    """
    known = stored(rows.select(group_key(F.col(group)).alias("__group"), F.col(id_).cast("long").alias("__id"), F.col(leaf).alias("__leaf"),
                               F.col(other).alias("__other")), "leaves")
    placed = coordinates(known, span)
    most = known.groupBy("__group").agg(F.count("*").alias("n")).agg(F.max("n"), F.count("*")).first()
    steps = climb(placed, most[0] or 0, levels)
    subroots = running_number(tops(steps, levels), ["__group"], "__place")
    none = F.lit(None).cast("long")
    whole = climb(subroots.select(F.lit("").alias("__group"), F.lit(most[1]).cast("long").alias("__n"), "__place", none.alias("__id"),
                                  F.col("top").alias("__leaf"), F.col("top").alias("__other")), most[1], levels)
    top = tops(whole, levels).first()
    root = bytes(top["top"]) if top else b""
    ends = whole[-1].select("__group").distinct().select("__group", F.lit(b"").alias("path"), F.lit(b"").alias("subroot"))
    above = descend(whole, ends, levels).drop("ids", "others", "top").mapInArrow(_pather(levels), PATHS)
    ends = stored(subroots.join(above.select("__place", "path"), "__place").select("__group", "path", F.col("top").alias("subroot")), "ends")
    fields = "__group string, __id long, place long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    out = descend(steps, ends, levels).drop("top").mapInArrow(_unfolder(root, levels, with_proof), fields + ", proof binary" * with_proof)
    source = F.when(F.col("__group") != "", F.expr("substring(__group, 2)"))
    return out.select(F.col("__id").alias(id_), source.alias(group), *[c for c in out.columns if c not in ("__group", "__id")])


def without_line_ends(docs: DataFrame) -> tuple[Column, Column]:
    """Leaves of ``docs``, and those of a replica that has lost the line ends of every text whose id's CRC-32 is even."""
    values = [F.col(c) for c in LEAF_COLUMNS]
    lost = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    own = leaf_hash(values)
    return own, F.when(hit, leaf_hash([*values[:-1], lost])).otherwise(own)

"""Removal of byte strings that occur twice, by a sparse suffix array sorted deep-shallow.

A position is removed when a string of ``length`` bytes that covers it starts at two or more
places of the corpus, the same document included.

1. Anchors.  Of the 32-byte grams in a window of ``length`` bytes, the one with the least hash is
   the window's anchor, the leftmost among equals.  Equal windows have their anchor at the same
   offset, so they meet under its gram.  About one position in 85 is an anchor.
2. A gram that occurs once in all distinct texts cannot anchor a repeated window.  The others send
   the bytes around them (at most 368) to a block chosen by the gram; of equal bytes around a frequent
   gram each task sends two, the rest are then known to be repeated.
3. A block sorts its anchors' suffixes, and the reversed prefixes before them, deep-shallow: a
   multikey sort over 8-byte symbols down to 64 bytes, then a blind trie for every group that is
   still tied, which stores branching bytes only and compares whole strings once per insertion.
   Both give the order and the longest common prefixes of neighbours.  A window at offset o before
   its anchor is repeated when another anchor shares its run of suffix prefixes >= length - o and
   its run of reversed prefixes >= o.
4. A gram with more than ``HOT`` anchors is settled by counting digests of its windows, with
   map-side sums, so no block grows with it.

Equal texts are one text with a count; a text of two or more copies is repeated as a whole.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import stored

GRAM = 32
SHALLOW = 64
PER_BLOCK = 16384
HOT = 200_000
#: A context whose gram has so many anchors is looked up among those its task has seen before it is sent, up to SEEN of them.
OFTEN, SEEN = 64, 100_000
_POSITION = np.uint64((1 << 23) - 1)


def anchors(data: np.ndarray, bounds: np.ndarray, length: int):
    """(gram, position, first window, last window) of each run of windows with the same anchor, positions in ``data``."""
    wide = length - GRAM + 1
    for a, b in _segments(bounds, length):
        part, cut = data[a:b], np.clip(bounds, a, b) - a
        n = len(part)
        if n < length:
            continue
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(W.LETTER[part] * W.powers(W.BASE, n), out=sums[1:])
        grams = W.mix((sums[GRAM:] - sums[:-GRAM]) * W.powers(W.UNBASE, n + 1)[:n - GRAM + 1])
        ranked = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        least = _sliding_least(ranked, wide)
        ends = cut[np.searchsorted(cut, np.arange(len(least)), "right")]
        window = np.flatnonzero(np.arange(len(least)) + length <= ends)
        if not len(window):
            continue
        at = (least[window] & _POSITION).astype(np.int64)
        new = np.ones(len(window), bool)
        new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        yield grams[at[first]].view(np.int64), at[first] + a, window[first] + a, window[last] + a


def _segments(bounds: np.ndarray, length: int):
    """Bounds of parts whose windows, taken together, are all windows; a part has at most 4 MB."""
    most, end = 4 << 20, int(bounds[-1])
    a = 0
    while True:
        b = min(end, a + most)
        yield a, b
        if b >= end:
            return
        a = b - length + 1


def _sliding_least(x: np.ndarray, wide: int) -> np.ndarray:
    """Least value of every run of ``wide`` values, from running minima inside blocks."""
    n = len(x)
    padded = np.full(-(-n // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - wide + 1], ahead[wide - 1:n])


def blind_trie(strings: list) -> tuple[list, list]:
    """Order of distinct byte strings, and the longest common prefix of each with the one before it.

    Inner nodes hold a depth and their children by the byte there.  A string goes down without looking
    at skipped bytes, is compared with the leaf it meets, and branches off where the two differ.
    """
    def byte(s, d):
        return s[d] if d < len(s) else -1

    root = 0
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while type(node) is list:
            node = node[1].get(byte(s, node[0])) if byte(s, node[0]) in node[1] else next(iter(node[1].values()))
        other = strings[node]
        same = common(s, other)
        above, node = None, root
        while type(node) is list and node[0] < same:
            above, node = node, node[1][byte(s, node[0])]
        if type(node) is list and node[0] == same:
            node[1][byte(s, same)] = i
            continue
        fresh = [same, {byte(other, same): node, byte(s, same): i}]
        if above is None:
            root = fresh
        else:
            above[1][byte(s, above[0])] = fresh
    order, shared, todo = [], [], [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if type(node) is list:
            children = [node[1][c] for c in sorted(node[1])]
            todo += [(c, node[0]) for c in reversed(children[1:])] + [(children[0], depth)]
        else:
            order.append(node)
            shared.append(depth)
    return order, shared


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def deep_shallow(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, shared) of byte strings in the rows of a zero-padded matrix.

    ``rank`` is the place of each row in sorted order, ``shared[r]`` the longest common
    prefix of the strings at places r - 1 and r.
    """
    n = len(rows)
    order, shared = np.arange(n), np.zeros(n, np.int64)
    tied = np.ones(n, bool)  # tied[r]: the string at place r isn't yet told from the one at r - 1
    tied[:1] = False
    symbols = np.ascontiguousarray(rows[:, :SHALLOW]).view(">u8").astype(np.uint64)
    for d in range(SHALLOW // 8):
        both = tied.copy()
        both[:-1] |= tied[1:]
        at = np.flatnonzero(both)
        if not len(at):
            break
        group = np.cumsum(~tied)[at]
        key = symbols[order[at], d]
        turn = np.lexsort((key, group))
        order[at], key = order[at][turn], key[turn]
        now = np.flatnonzero(tied[at])
        differ = key[now] ^ key[now - 1]
        shared[at[now]] = 8 * d + _equal_bytes(differ)
        tied[at[now]] = differ == 0
    both = np.flatnonzero(tied)
    if len(both):
        starts = both[np.concatenate([[True], np.diff(both) > 1])] - 1
        ends = both[np.concatenate([np.diff(both) > 1, [True]])] + 1
        for a, b in zip(starts, ends):
            _deep(rows, size, order, shared, a, b)
    shared[1:] = np.minimum(shared[1:], np.minimum(size[order[1:]], size[order[:-1]]))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return rank, shared


def _deep(rows, size, order, shared, a, b):
    """Order places a .. b - 1, which agree in their first ``SHALLOW`` bytes, with a blind trie."""
    same: dict = {}
    for i in order[a:b].tolist():
        same.setdefault(rows[i, SHALLOW:max(SHALLOW, size[i])].tobytes(), []).append(i)
    strings = list(same)
    turn, depth = blind_trie(strings)
    at = a
    for k, d in zip(turn, depth):
        members = same[strings[k]]
        order[at:at + len(members)] = members
        if at > a:
            shared[at] = SHALLOW + d
        shared[at + 1:at + len(members)] = rows.shape[1]
        at += len(members)


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Leading equal bytes of two 8-byte symbols, from their exclusive or."""
    out = np.full(len(differ), 8)
    for k in range(7, -1, -1):
        out[differ >= np.uint64(1 << 8 * (7 - k))] = k
    return out


def _matrix(strings: list, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows, zero-padded to ``wide``, and their sizes."""
    size = np.array([len(s) for s in strings], np.int64)
    rows = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8).reshape(len(strings), wide)
    return rows, size


def _sorter(length: int):
    before = -(-(length - GRAM) // 8) * 8
    after = -(-length // 8) * 8

    def repeated(table: pa.Table) -> pa.Table:
        """Runs of repeated windows in a block: key, first byte, byte after the last.  Rows without bytes are settled."""
        settled = table.filter(pc.is_null(table.column("around")))
        table = table.filter(pc.is_valid(table.column("around")))
        done = pa.table({"key": settled.column("key"), "a": pc.subtract(settled.column("at"), settled.column("hi")),
                         "b": pc.add(pc.subtract(settled.column("at"), settled.column("lo")), length)})
        if not len(table):
            return done
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        around, n = table.column("around").to_pylist(), len(lo)
        right = deep_shallow(*_matrix([c[h:] for c, h in zip(around, hi.tolist())], max(after, SHALLOW)))
        left = deep_shallow(*_matrix([c[:h][::-1] for c, h in zip(around, hi.tolist())], max(before, SHALLOW)))
        hit = np.zeros((n, int(hi.max()) + 2), bool)
        for o in range(int(lo.min()), int(hi.max()) + 1):
            own = np.flatnonzero((lo <= o) & (o <= hi))
            if len(own) < 2:
                continue
            run = np.cumsum(right[1] < length - o)[right[0][own]] * (n + 1) + np.cumsum(left[1] < o)[left[0][own]]
            turn = np.argsort(run, kind="stable")
            twin = np.flatnonzero(run[turn][1:] == run[turn][:-1])
            hit[own[turn[twin]], o] = True
            hit[own[turn[twin + 1]], o] = True
        edge = np.diff(hit.astype(np.int8), axis=1, prepend=0)
        row, start = np.nonzero(edge == 1)
        _, stop = np.nonzero(edge == -1)
        at = table.column("at").to_numpy()[row]
        found = pa.table({"key": table.column("key").take(pa.array(row)), "a": pa.array(at - stop + 1), "b": pa.array(at - start + length)})
        return pa.concat_tables([found, done])

    return repeated


def _grams(length: int):
    def run(batches):
        for batch in batches:
            for at, data, bounds in W.pieces(batch.column("text")):
                found = [(np.zeros(0, np.int64),) * 2, *((g, p) for g, p, _, _ in anchors(data, bounds, length))]
                gram, place = (np.concatenate(x) for x in zip(*found))
                text = np.searchsorted(bounds, place, "right") - 1
                order = np.argsort(text, kind="stable")
                counts = np.bincount(text, minlength=len(bounds) - 1)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(gram[order]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(counts)), batch.column("key").slice(at, len(counts)), lists], names=["doc_id", "key", "grams"])

    return run


def _contexts(length: int):
    """The bytes around those anchors of each class's first text whose gram is wanted; none for those that are settled."""
    def run(batches):
        seen: dict = {}
        for batch in batches:
            own = np.flatnonzero(pc.equal(batch.column("doc_id"), batch.column("rep")).to_numpy(zero_copy_only=False))
            batch = batch.take(pa.array(own))
            for at, data, bounds in W.pieces(batch.column("text")):
                wanted = batch.column("wanted").slice(at, len(bounds) - 1)
                owner = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
                values = wanted.flatten()
                per_text = {}
                for i, g, n in zip(owner.tolist(), values.field(0).to_pylist(), values.field(1).to_pylist()):
                    per_text.setdefault(i, {})[g] = n
                out = [[] for _ in range(7)]
                raw = data.tobytes()
                for gram, place, first, last in anchors(data, bounds, length):
                    text = np.searchsorted(bounds, place, "right") - 1
                    for g, p, f, t, i in zip(gram.tolist(), place.tolist(), first.tolist(), last.tolist(), text.tolist()):
                        n = per_text.get(i, {}).get(g)
                        if n is None:
                            continue
                        around = raw[f:t + length]
                        if n >= OFTEN:
                            times = seen.get((g, p - t, around), 0)
                            if times > 1:
                                around = None
                            elif times or len(seen) < SEEN:
                                seen[g, p - t, around] = times + 1
                        for o, x in zip(out, (i, g, n > HOT and around is not None, p - int(bounds[i]), p - t, p - f, around)):
                            o.append(x)
                keys = batch.column("key").slice(at, len(bounds) - 1).take(pa.array(out[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(out[1], pa.int64()), pa.array(out[2], pa.bool_()),
                                                  *[pa.array(x, pa.int64()) for x in out[3:6]], pa.array(out[6], pa.binary())],
                                                 names=["key", "gram", "hot", "at", "lo", "hi", "around"])

    return run


def _windows(length: int):
    """All windows of the anchors of hot grams, each as its digest and place."""
    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for o in range(r["lo"], r["hi"] + 1):
                    window = r["around"][r["hi"] - o:r["hi"] - o + length]
                    rows.append({"key": r["key"], "p": r["at"] - o, "digest": hashlib.md5(window).digest()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.binary()), ("p", pa.int64()), ("digest", pa.binary())]))

    return run


def _removed(length: int):
    def run(batches):
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, 256)
                at += 256
                out = []
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for doc_id, text, copies, runs in zip(part.column("doc_id").to_pylist(), texts, part.column("copies").to_pylist(), part.column("runs").to_pylist()):
                    text = text or b""
                    if copies > 1 and len(text) >= length:
                        runs = [{"a": 0, "b": len(text)}]
                    kept, end, gone, spans = [], 0, 0, []
                    for r in sorted((r["a"], r["b"]) for r in runs or ()):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], r[1])
                        else:
                            spans.append(list(r))
                    for a, b in spans:
                        kept.append(text[end:a])
                        gone, end = gone + b - a, b
                    kept.append(text[end:])
                    out.append((doc_id, len(text), gone, len(spans), b"".join(kept), spans))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols[0], pa.int64()), *[pa.array(c, pa.int64()) for c in cols[1:4]],
                    pa.array([hashlib.sha256(k).hexdigest() for k in cols[4]]), pa.array(cols[4], pa.binary()),
                ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes.

    Texts are UTF-8 bytes, a null text is empty; strings never cross a document.  Repeated rows are copies
    of each other, whatever their doc_id, so all their bytes go if they have ``length`` or more.  A null
    doc_id stays null.  Other columns are ignored.  ``length`` has to be 64 or more.
    """
    base = importable(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # never null, so that both joins below deal out the same texts in the same way and Spark does it once
    base = base.withColumn("key", F.coalesce(F.unhex(F.md5("text")), F.lit(b"")))
    listed = base.mapInArrow(_grams(length), "doc_id long, key binary, grams array<long>")
    texts = stored(listed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("grams").alias("grams")), "texts")
    # a short id is enough here: two texts that share one only get more grams looked at
    each = texts.select(F.xxhash64("key").alias("id"), F.explode("grams").alias("gram"))
    # written, so that the join below has two shuffled sides and Spark can split the part of a hot gram
    often = stored(each.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "often")
    wanted = stored(each.join(often, "gram").groupBy("id").agg(F.collect_set(F.struct("gram", "n")).alias("wanted")), "wanted")
    sizes = wanted.agg(F.sum(F.size("wanted")).alias("all"), F.max(F.array_max(F.transform("wanted", lambda w: w["n"]))).alias("most")).first()
    blocks = 1 + (sizes["all"] or 0) // PER_BLOCK
    asked = texts.select("key", "rep", F.xxhash64("key").alias("id")).join(wanted, "id").select("key", "rep", "wanted")
    # which copies count as settled follows from what a task has seen, so it is decided once and written
    around = stored(base.join(asked, "key").select("doc_id", "rep", "key", "text", "wanted").mapInArrow(
        _contexts(length), "key binary, gram long, hot boolean, at long, lo long, hi long, around binary"), "contexts")
    # settled rows carry no bytes and may go to any block
    block = F.pmod(F.when(F.col("around").isNull(), F.xxhash64("key")).otherwise(F.col("gram")), F.lit(blocks))
    every = around.where("NOT hot").withColumn("block", block).groupBy("block").applyInArrow(_sorter(length), "key binary, a long, b long")
    if (sizes["most"] or 0) > HOT:
        windows = stored(around.where("hot").mapInArrow(_windows(length), "key binary, p long, digest binary"), "windows")
        twice = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
        every = every.unionByName(windows.join(twice, "digest").select("key", F.col("p").alias("a"), (F.col("p") + length).alias("b")))
    per_text = every.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    out = base.join(texts.select("key", "copies").join(per_text, "key", "left"), "key", "left").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.expr("nullif(doc_id, -9223372036854775808)"))

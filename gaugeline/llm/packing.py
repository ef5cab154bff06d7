"""Best-fit packing of documents into fixed token sequences by minimum bin slack.

Every document becomes token ids and an end id; only what is longer than a sequence is cut, into full sequences and a
rest.  The rests are packed bin by bin: the longest rest that is left opens a bin, and a subset-sum over the lengths that are
left, held as one bitset a length, finds the fullest combination for the remaining room, which is then removed.

All rests of one length are alike, so the search needs the histogram of lengths only, at most ``capacity`` numbers whatever the size
of the table.  A combination stays the best one until a length that it uses runs short, so it is taken as often
as its lengths allow: the bins are those of the bin-by-bin search, in at most about ``capacity * ln(capacity)`` steps.  The
steps say which ranks of a length go where; rows find their place from their rank within their length.

Ranks are running numbers of the tasks that made the pieces, plus what earlier tasks have of the length: no row is sorted, and
a length that most rows share is counted in every task.
"""

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, Window

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import stored

CAPACITY = 2048
END = 0
#: Bytes of text that are tokenised at once, and distinct parts of texts that a worker remembers.
SEGMENT, PARTS = 1 << 20, 1 << 20
#: Fixed value: the split pattern of the tokenizer that is read part by part.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK, LETTER, DIGIT, OTHER, ODD = range(5)
KIND = np.full(256, ODD, np.uint8)
KIND[0x21:0x7F] = OTHER
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[0x30:0x3A] = DIGIT
KIND[W.SPACE] = BLANK
#: Second bytes of the letters from U+00C0 to U+00FF, which all start with 0xC3: all but the signs of multiplication and division.
SECOND = np.zeros(256, bool)
SECOND[0x80:0xC0] = True
SECOND[[0x97, 0xB7]] = False
APART = np.uint64(0xA5A5A5A5A5A5A5A5)
_encoders: dict = {}


def byte_letters() -> dict[int, int]:
    """Bytes as the letters of a byte-level vocabulary: printable Latin-1 is itself, the others follow from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}


def parts_of(data: np.ndarray, bounds: np.ndarray, special: list[bytes]):
    """The parts that the tokenizer splits texts into: (lower-cased bytes, starts, ends, whether odd).

    Runs of letters, single digits, runs of other signs; an apostrophe that starts a part takes its s, t, re, ve, m, ll or d along.  A blank-separated word
    with anything beyond printable ASCII and Latin-1 letters, or with a special token, is one odd part that the tokenizer itself has to split.
    """
    kind = KIND[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & SECOND[data[1:]]
    latin = second.copy()
    latin[:-1] |= second[1:]
    kind[latin] = LETTER
    low = W.LOWER[data]
    low[second & (data < 0x9F)] += 0x20
    if special:
        raw = data.tobytes()
        for s in special:
            at = raw.find(s)
            while at >= 0:
                kind[at] = ODD
                at = raw.find(s, at + 1)
    first, last = W.spans(kind != BLANK, bounds)
    start = np.zeros(len(data), bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= kind == DIGIT
    start[first] = True
    start &= kind != BLANK
    quotes = np.flatnonzero(start & (data == 0x27))
    stop = last[np.searchsorted(first, quotes, "right") - 1]
    one, two = (np.where(quotes + i < stop, low[np.minimum(quotes + i, len(low) - 1)], 0) for i in (1, 2))
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.zeros(len(quotes), bool)
    for pair in (b"re", b"ve", b"ll"):
        long |= (one == pair[0]) & (two == pair[1])
    for which, size in ((short, 2), (long, 3)):
        at = quotes[which]
        start[at + 1] = False
        after = at + size
        after = after[after < stop[which]]
        start[after[kind[after] == LETTER]] = True
    odds = np.concatenate([[0], np.cumsum(kind == ODD)])
    odd_word = odds[last] > odds[first]
    if odd_word.any():
        inside = np.zeros(len(data) + 1, np.int8)
        inside[first[odd_word]] += 1
        np.add.at(inside, last[odd_word], -1)
        inside = np.cumsum(inside[:-1]).astype(bool)
        low[inside] = data[inside]
        start[inside] = False
        start[first[odd_word]] = True
    starts = np.flatnonzero(start)
    word = np.searchsorted(first, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), last[word]) if len(starts) else starts
    return low, starts, ends, odd_word[word]


class Table:
    """Ids of known parts: sorted hashes, and where their ids stand."""

    def __init__(self):
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, h: np.ndarray):
        place = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        return place, (self.keys[place] == h if len(self.keys) else np.zeros(len(h), bool))

    def add(self, h: np.ndarray, ids: list) -> None:
        n = np.array([len(i) for i in ids], np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.array([x for i in ids for x in i], np.uint32)])
        place = np.searchsorted(self.keys, h)
        self.keys, self.at, self.n = (np.insert(old, place, new) for old, new in ((self.keys, h), (self.at, at), (self.n, n)))


class Encoder:
    """Token ids of texts, remembered part by part.

    For a tokenizer that lower-cases, drops white space and splits by ``SPLIT``, the ids of a text are those of its parts one after the other; a part is
    tokenised when it is first seen.  Parts are told apart by 64-bit hashes.  Any other tokenizer gets whole texts.
    """

    letters = byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_part = (normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                        and steps[0]["pattern"] == {"Regex": SPLIT} and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
                        and not steps[1]["add_prefix_space"] and spec.get("post_processor") is None)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.known, self.fresh = Table(), Table()

    def whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def part(self, part: bytes, odd: bool) -> list[int]:
        if odd:
            return self.whole(part)
        letters = part.decode() if part.isascii() else part.decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each text has)."""
        if not self.by_part:
            each = [self.whole(data[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            return np.array([i for ids in each for i in ids], np.uint32), np.array([len(i) for i in each], np.int64)
        low, starts, ends, odd = parts_of(data, bounds, self.special)
        h = W.hashes(low, starts, ends)
        h[odd] ^= APART
        distinct, place, same = np.unique(h, return_index=True, return_inverse=True)
        _, old = self.known.find(distinct)
        _, seen = self.fresh.find(distinct)
        new = np.flatnonzero(~old & ~seen)
        if len(self.known.keys) + len(self.fresh.keys) + len(new) > PARTS:
            self.known, self.fresh, new = Table(), Table(), np.arange(len(distinct))
        raw = low.tobytes()
        ids = [self.part(raw[a:b], o) for a, b, o in zip(starts[place[new]].tolist(), ends[place[new]].tolist(), odd[place[new]].tolist())]
        self.fresh.add(distinct[new], ids)
        if len(self.fresh.keys) > 1 << 16 or not len(self.known.keys):  # large tables are rebuilt now and then only
            moved, self.fresh = self.fresh, Table()
            at = len(self.known.ids)
            self.known.ids = np.concatenate([self.known.ids, moved.ids])
            spot = np.searchsorted(self.known.keys, moved.keys)
            self.known.keys, self.known.at, self.known.n = (
                np.insert(a, spot, b) for a, b in ((self.known.keys, moved.keys), (self.known.at, moved.at + at), (self.known.n, moved.n)))
        k, old = self.known.find(distinct)
        f, _ = self.fresh.find(distinct)
        if len(self.fresh.keys):
            pool = np.concatenate([self.known.ids, self.fresh.ids]) if not old.all() else self.known.ids
            at = np.where(old, self.known.at[k], self.fresh.at[f] + len(self.known.ids))[same]
            n = np.where(old, self.known.n[k], self.fresh.n[f])[same]
        else:
            pool, at, n = self.known.ids, self.known.at[k][same] if len(k) else k, self.known.n[k][same] if len(k) else k
        total = np.cumsum(n)
        out = pool[np.repeat(at - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        upto = np.concatenate([[0], total])
        return out, np.diff(upto[np.searchsorted(starts, bounds)])

    def texts(self, column: pa.Array):
        """(row, ids) of every text; what is longer than a segment is tokenised in parts that end before white space."""
        for at, data, bounds in W.pieces(column, SEGMENT):
            if len(bounds) == 2 and len(data) > SEGMENT and self.by_part:
                out, a = [], 0
                while a < len(data):
                    b = _cut(data, a)
                    out.append(self.ids(data[a:b], np.array([0, b - a]))[0])
                    a = b
                yield at, np.concatenate(out)
                continue
            ids, n = self.ids(data, bounds)
            ends = np.cumsum(n)
            for i, (a, b) in enumerate(zip((ends - n).tolist(), ends.tolist())):
                yield at + i, ids[a:b]


def _cut(data: np.ndarray, at: int) -> int:
    """The next white space after a segment's length, however far it is; the end if there is none."""
    for a in range(at + SEGMENT, len(data), SEGMENT):
        blank = np.flatnonzero(W.SPACE[data[a:a + SEGMENT]])
        if len(blank):
            return a + int(blank[0])
    return len(data)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _cutter(path: str, capacity: int, end: int, with_ids: bool):
    def cut(batches):
        coder, task, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last = np.array([end], np.uint32)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                rows, pieces, length, crc, ids = [], [], [], [], []
                for row, all_ids in coder.texts(part.column("__text").cast(pa.large_binary())):
                    all_ids = np.concatenate([all_ids, last])
                    for k in range(0, len(all_ids), capacity):
                        own = all_ids[k:k + capacity]
                        rows.append(row)
                        pieces.append(k // capacity)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.astype("<u4", copy=False)))
                        if with_ids:
                            ids.append(own.astype(np.int64))
                length = np.array(length, np.int64)
                order = np.argsort(length, kind="stable")
                new = np.diff(length[order], prepend=-1) != 0
                within = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                rank = np.empty(len(order), np.int64)
                rank[order] = within + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                kept = part.take(pa.array(rows, pa.int64())).drop_columns(["__text"])
                arrays = [*kept.columns, pa.array(pieces, pa.int32()), pa.array(np.array(pieces, np.int64) * capacity), pa.array(length),
                          pa.array(crc, pa.int64()), pa.array(np.full(len(rows), task), pa.int32()), pa.array(rank)]
                names = [*kept.schema.names, "piece", "start", "length", "ids_crc32", "__task", "__rank"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return cut


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep=("doc_id",), with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: the ``keep`` columns, piece, start, length, ids_crc32, their task and rank, and ids if wanted."""
    df = importable(docs).select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    fields = "".join(f"`{n}` {t}, " for n, t in df.dtypes[:-1]) + "piece int, start long, length long, ids_crc32 long, __task int, __rank long"
    return df.mapInArrow(_cutter(path, capacity, end, with_ids), fields + ", ids array<long>" * with_ids)


class Slack:
    """Subset sums of the lengths that are left: entry i has the sums that the i shortest lengths reach."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.lengths = sorted(counts)
        self.sums, self.good = [1] * (len(self.lengths) + 1), 0  # entries up to good are right

    def with_copies(self, sums: int, length: int, copies: int, room: int) -> int:
        """Sums with 0 to ``copies`` further items of a length, in doubling steps."""
        mask, step = (1 << (room + 1)) - 1, 1
        while copies > 0:
            step = min(step, copies)
            sums |= (sums << (step * length)) & mask
            copies -= step
            step *= 2
        return sums

    def reach(self, upto: int) -> None:
        for i in range(self.good, upto):
            n = self.lengths[i]
            self.sums[i + 1] = self.with_copies(self.sums[i], n, min(self.left[n], self.capacity // n), self.capacity)
        self.good = max(self.good, upto)

    def fullest(self, seed: int) -> dict[int, int]:
        """The combination with ``seed`` that leaves least room, longer items first among equals."""
        room = self.capacity - seed
        self.left[seed] -= 1
        top = np.searchsorted(self.lengths, min(room, seed), "right")
        own = top and self.lengths[top - 1] == seed  # the seed's own length has one copy less now
        self.reach(top - bool(own))
        sums = self.sums[top - bool(own)]
        if own:
            sums = self.with_copies(sums, seed, min(self.left[seed], room // seed), room)
        target = (sums & ((1 << (room + 1)) - 1)).bit_length() - 1
        out = {seed: 1}
        for i in range(top - 1, -1, -1):
            n = self.lengths[i]
            if n <= target:
                k = min(self.left[n], target // n)
                while not self.sums[i] >> (target - k * n) & 1:
                    k -= 1
                if k:
                    out[n] = out.get(n, 0) + k
                    target -= k * n
            if not target:
                break
        self.left[seed] += 1
        return out

    def remove(self, bin_: dict[int, int], times: int) -> None:
        for n, k in bin_.items():
            before = min(self.left[n], self.capacity // n)
            self.left[n] -= k * times
            if min(self.left[n], self.capacity // n) != before:
                self.good = min(self.good, int(np.searchsorted(self.lengths, n)))


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) of all bins for a histogram of lengths from 1 to ``capacity``."""
    slack = Slack({n: c for n, c in counts.items() if c > 0}, capacity)
    steps = []
    for seed in reversed(slack.lengths):
        while slack.left[seed]:
            bin_ = slack.fullest(seed)
            times = min(slack.left[n] // k for n, k in bin_.items())
            slack.remove(bin_, times)
            steps.append((times, bin_))
    return steps


def _places(steps) -> dict[int, np.ndarray]:
    """By length, in order of rank: first rank, copies in a bin, first sequence, place in the bin."""
    taken, first, out = {}, 0, {}
    for times, bin_ in steps:
        at = 0
        for n, k in sorted(bin_.items(), reverse=True):
            out.setdefault(n, []).append((taken.get(n, 0), k, first, at))
            taken[n] = taken.get(n, 0) + k * times
            at += k * n
        first += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def _placer(places):
    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1)).tolist() + [len(order)]
            for a, b in zip(edges, edges[1:]):
                rows = order[a:b]
                table = places.value[int(length[rows[0]])]
                step = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                inside = rank[rows] - step[:, 0]
                sequence[rows] = step[:, 2] + inside // step[:, 1]
                offset[rows] = step[:, 3] + inside % step[:, 1] * length[rows]
            kept = batch.drop_columns(["__rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"])

    return place


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep=("doc_id",), with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its place: the ``keep`` columns, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    ``path`` is a tokenizer file that driver and workers can read.  A null or empty text is its end id alone.  A text is never cut at less than
    ``capacity`` ids, however long it is; long ones are tokenised in parts.  Repeated rows are documents of their own; which of several
    equally long pieces gets which place is open.  An empty table gives no row.  Further columns of ``docs`` don't matter; a kept column may
    not carry the name of a result.
    """
    pieces = stored(cut_pieces(docs, path, capacity, end, keep, with_ids), "pieces")
    by_task = pieces.groupBy("__task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(by_task.select("__task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first")), "piece-counts")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    places = docs.sparkSession.sparkContext.broadcast(_places(plan_bins(counts, capacity)))  # bounded by capacity, not by rows
    ranked = pieces.join(starts.drop("n"), ["__task", "length"]).withColumn("__rank", F.col("__rank") + F.col("__first"))
    names = [*keep, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = ranked.select(*names, "__rank")
    fields = "".join(f"`{n}` {t}, " for n, t in ranked.dtypes[:-1]) + "sequence_id long, offset long"
    out = ranked.mapInArrow(_placer(places), fields)
    return out.select(*[c for c in names if c != "ids"], "sequence_id", "offset", *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: sequence_id, ids, and (first column kept, piece, offset, length) of their parts in order."""
    owner = packed.columns[0]
    part = F.struct("offset", F.col(owner).alias("owner"), "piece", "length", "ids")
    parts = F.array_sort(F.collect_list(part))  # at most capacity pieces
    out = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return out.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                      F.transform("parts", lambda p: F.struct(p["owner"].alias("owner"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("parts"))

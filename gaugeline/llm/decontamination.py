"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Text and items are normalised alike: A-Z lower-cased, words are runs of digits, lower-case
letters and non-ASCII bytes, joined by single blanks.  Every window of ``size`` item words is
a pattern with a blank at both ends, so patterns match whole words only.  A text is
scanned once per automaton; a match is turned back into word numbers and from there
into code points of the original text.

The items are the stated query set.  They are read in blocks of at most ``BLOCK_BYTES`` of text (or one
longer item), one automaton a block of about 3 million nodes, so no automaton grows with the table.
A usual benchmark is one block.  More blocks go over a chunk of texts one after the other; a worker keeps the last four automata.
At most ``PASS_BYTES`` of items are with the driver and the workers at a time: beyond that the texts are written with what
was found so far and read again with the next items.
"""

import hashlib
import pickle

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import discard, stored

BLOCK_BYTES = 256 << 10
PASS_BYTES = 64 << 20
#: Texts that one automaton scans before the next block's takes its place.
CHUNK_BYTES = 32 << 20
KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Byte by byte: what stays in a word, lower-cased; all else is a blank.
NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in KEPT else 0x20 for c in range(256))
_automata: dict = {}


def normal_words(text: bytes) -> list[bytes]:
    # split() without arguments would also cut at bytes that stand for blanks in other encodings
    return [w for w in text.translate(NORMAL).split(b" ") if w]


def windows(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words; a shorter item is one window, an item without words none."""
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def _automaton(key: str, packed: bytes, size: int):
    """The automaton of one block of items, kept by the worker for its next batches."""
    if key not in _automata:
        if len(_automata) > 3:
            _automata.clear()
        owners: dict[bytes, set] = {}
        for item, text in pickle.loads(packed):
            for w in windows(normal_words(text), size):
                owners.setdefault(w, set()).add(item)
        built = ahocorasick.Automaton()
        for w, items in owners.items():
            built.add_word(" " + w.decode("latin-1") + " ", (w.count(b" ") + 1, len(w) + 2, frozenset(items)))
        if owners:
            built.make_automaton()
        _automata[key] = built if owners else None
    return _automata[key]


def _line(words: list[bytes]) -> str:
    return " " + b" ".join(words).decode("latin-1") + " "


def _mark(line: str, automaton, covered: np.ndarray, items: set) -> None:
    """Mark the words of ``line`` inside a match and add the items that the matches belong to."""
    hits = [(end - width + 1, n, owners) for end, (n, width, owners) in automaton.iter(line)]
    if hits:
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        for first, (_, n, owners) in zip(np.searchsorted(blanks, [h[0] for h in hits]).tolist(), hits):
            covered[first:first + n] = True
            items |= owners


def _runs(covered: np.ndarray):
    """(first word, word after the last) of each run of covered words."""
    edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _chunks(texts: pa.Array):
    """(start, rows) of runs of texts with at most ``CHUNK_BYTES`` together, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > CHUNK_BYTES:
            yield start, i - start
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes) - start


def _offsets(text: bytes, runs) -> list[dict]:
    """Code-point spans of runs of words."""
    starts, ends = W.spans(np.frombuffer(text.translate(NORMAL), np.uint8) != 0x20, np.array([0, len(text)]))
    point = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(point[starts[a]]), "end": int(point[ends[b - 1]])} for a, b in runs]


RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scanner(blocks, size: int, last: bool):
    """Scan (__scan, __runs, __items, kept columns) with the automata of ``blocks``, adding to the runs and items found before.

    The last pass gives the results in place of text and runs.
    """
    def scan(batches):
        for batch in batches:
            for at, rows in _chunks(batch.column("__scan").cast(pa.binary())):
                part = batch.slice(at, rows)
                texts = [t or b"" for t in part.column("__scan").cast(pa.binary()).to_pylist()]
                lines, covered, items = [], [], []
                for text, runs, before in zip(texts, part.column("__runs").to_pylist(), part.column("__items").to_pylist()):
                    words = normal_words(text)
                    lines.append(_line(words) if words else "")
                    covered.append(np.zeros(len(words), bool))
                    for r in runs:
                        covered[-1][r["a"]:r["b"]] = True
                    items.append(set(before))
                for key, packed in blocks:  # outside the texts: one automaton at a time
                    automaton = _automaton(key, packed.value, size)
                    if automaton is not None:
                        for line, c, found in zip(lines, covered, items):
                            if line:
                                _mark(line, automaton, c, found)
                runs = [_runs(c) for c in covered]
                listed = [sorted(found) for found in items]
                kept, names = part.columns[3:], part.schema.names[3:]
                if not last:
                    yield pa.RecordBatch.from_arrays([
                        part.column("__scan"), pa.array([[{"a": a, "b": b} for a, b in r] for r in runs], RUNS),
                        pa.array(listed, pa.list_(pa.string())), *kept], names=["__scan", "__runs", "__items", *names])
                    continue
                yield pa.RecordBatch.from_arrays([
                    *kept, pa.array([len(c) for c in covered], pa.int64()), pa.array([int(c.sum()) for c in covered], pa.int64()),
                    pa.array(listed, pa.list_(pa.string())), pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in listed]),
                    pa.array([_offsets(t, r) if r else [] for t, r in zip(texts, runs)], SPANS),
                ], names=[*names, "n_words", "n_hit", "items", "items_sha256", "spans"])

    return scan


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text"):
    """Blocks of (item_id as string, UTF-8 text) as (digest, bytes), filled as the rows come in; items without id or text have no window."""
    now, size = [], 0
    rows = items.select(F.col(item_id).cast("string"), F.col(text).cast("string")).dropna()
    for i, t in rows.toLocalIterator():
        raw = t.encode()
        if now and size + len(raw) > BLOCK_BYTES:
            yield _packed(now)
            now, size = [], 0
        now.append((i, raw))
        size += len(raw)
    if now:
        yield _packed(now)


def _packed(block):
    packed = pickle.dumps(sorted(block))
    return hashlib.sha256(packed).hexdigest(), packed


def _passes(blocks):
    """Lists of blocks with at most ``PASS_BYTES`` together, or of one larger block, each with whether it is the last; one list at least."""
    now, size = [], 0
    for key, packed in blocks:
        if now and size + len(packed) > PASS_BYTES:
            yield now, False
            now, size = [], 0
        now.append((key, packed))
        size += len(packed)
    yield now, True


def find_contamination(docs: DataFrame, items: DataFrame, size: int = 10, keep=("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_words, n_hit, n_items, items, items_sha256, spans, contaminated.

    A word is hit when it lies inside any occurrence of a window of an item.  ``items`` are the ids,
    sorted as strings, of the items with an occurring window; ``spans`` the runs of hit words as code points
    of the original text, end exclusive.  A null or wordless text has no words and no hit.  Items with the same
    windows all count, a repeated item_id counts once.  Rows keep their order of columns; repeated rows are
    each judged; an empty table on either side gives no hit.  A kept column may not carry the name of a result, nor ``__scan``, ``__runs`` or ``__items``.
    """
    own = [F.col(c) for c in keep]
    df = importable(docs).select(F.col("text").cast("string").alias("__scan"),
                                 F.expr("cast(array() AS array<struct<a: long, b: long>>)").alias("__runs"),
                                 F.expr("cast(array() AS array<string>)").alias("__items"), *own)
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes[3:])
    state = "__scan string, __runs array<struct<a: long, b: long>>, __items array<string>" + (f", {fields}" if fields else "")
    result = "n_words long, n_hit long, items array<string>, items_sha256 string, spans array<struct<start: long, end: long>>"
    context, before = docs.sparkSession.sparkContext, None
    for blocks, last in _passes(item_blocks(items)):
        sent = [(key, context.broadcast(packed)) for key, packed in blocks]
        if last:
            out = df.mapInArrow(_scanner(sent, size, True), f"{fields}, {result}" if fields else result)
            break
        df = stored(df.mapInArrow(_scanner(sent, size, False), state), "scanned")
        for _, packed in sent:
            packed.destroy()
        if before is not None:
            discard(before)
        before = df
    return out.select(*keep, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "items_sha256", "spans",
                      (F.col("n_hit") > 0).alias("contaminated"))

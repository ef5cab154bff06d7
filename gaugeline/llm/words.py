"""Words and word shingles of whole Arrow batches, found with numpy on UTF-8 bytes.

Texts are never joined: a word ends where its text ends.  A null text counts as
empty.  Work goes through pieces of at most ``PIECE`` bytes (or one longer text),
which bounds the memory of a task whatever the size of a batch.
"""

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
LETTER = np.random.Generator(np.random.PCG64(20240117)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string array; text i is bytes[bounds[i]:bounds[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), bounds


def pieces(column: pa.Array, most: int = PIECE):
    """Yield (first row, bytes, bounds from 0) over runs of rows of at most ``most`` bytes, or one longer row."""
    data, bounds = utf8(column)
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at]
        at = to


def spans(is_word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run crosses the end of a text."""
    n = len(is_word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTER[data] * powers(BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(UNBASE, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray):
    """Lower-cased blank-separated words: (hash, index of the text, start, end) in order."""
    low = LOWER[data]
    starts, ends = spans(~SPACE[low], bounds)
    return hashes(low, starts, ends), np.searchsorted(bounds, starts, "right") - 1, starts, ends


def shingles(word: np.ndarray, text: np.ndarray, n_texts: int, size: int):
    """(hash, index of the text) of all runs of ``size`` words; a shorter text is one shingle, one without words none."""
    count = np.bincount(text, minlength=n_texts)
    first = np.cumsum(count) - count
    kept = max(0, len(word) - size + 1)
    whole = np.zeros(kept, np.uint64)
    for i in range(size):
        whole = whole * BASE + word[i:i + kept]
    owner = text[:kept]
    inside = np.flatnonzero(owner == text[size - 1:size - 1 + kept]) if kept else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(short), np.uint64)
    for i in range(size - 1):
        has = count[short] > i
        extra[has] = extra[has] * BASE + word[first[short[has]] + i]
    extra = extra + count[short].astype(np.uint64) * LETTER[0]
    h = mix(np.concatenate([whole[inside], extra]))
    return h, np.concatenate([owner[inside], short])


def distinct(text: np.ndarray, h: np.ndarray):
    """Distinct (text, hash) pairs in order of the text."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]

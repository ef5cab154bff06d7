"""Secret scans: keyword automaton, anchored patterns near hits, checksums.

1. One Aho-Corasick pass over the ASCII-lower-cased bytes finds keywords.  Hex strings have no
   keyword, so the same pass idea runs on a second view in which every hex digit is ``h``: 24 of
   them in a row are its only keyword.
2. Only at a hit is a pattern tried, anchored there.  Hits come in order of their start and a hit
   inside an earlier match of its kind is skipped, so the matches are the leftmost non-overlapping ones.
3. Formats that carry a checksum are kept only if it is right: GitHub and npm tokens end in the
   CRC-32 of their body, in base 62.
"""

import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from gaugeline.llm.workers import importable

# Token formats and their order.
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
            "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
PATTERNS = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HEXED = bytes(0x68 if c in b"0123456789abcdef" else 0x20 for c in range(256))
RUN = b"h" * LEAST_HEX
_state: dict = {}


def automaton():
    if "keywords" not in _state:
        built = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            built.add_word(word, (kind, len(word)))
        built.make_automaton()
        _state["keywords"] = built
    return _state["keywords"]


def checksum(body: bytes) -> bytes:
    """CRC-32 of the body in six base-62 digits."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d:d + 1] + out
    return out


def _good(kind: str, m) -> bool:
    if kind == "assign":
        return len(m[1]) >= LEAST_VALUE
    if kind == "access":
        return len(m[0]) >= LEAST_ACCESS
    if kind == "hex":
        return len(m[0]) >= LEAST_HEX
    return checksum(m[1]) == m[2]


def find_secrets(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start and then kind."""
    hits = {(end - n + 1, kind) for end, (kind, n) in automaton().iter(text.translate(LOWER).decode("latin-1"))}
    hexed = text.translate(HEXED)
    at = hexed.find(RUN)
    while at >= 0:
        hits.add((at, "hex"))
        end = hexed.find(b" ", at)
        at = hexed.find(RUN, end) if end >= 0 else -1
    found, passed = [], dict.fromkeys(KINDS, 0)
    for start, kind in sorted(hits):
        if start < passed[kind]:
            continue
        m = PATTERNS[kind].match(text, start)
        if m:
            passed[kind] = m.end()
            if _good(kind, m):
                found.append((kind, start, m.end()))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _points(text: bytes, spans):
    """The same spans in code points."""
    if not spans or text.isascii():
        return spans
    point = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(k, int(point[a]), int(point[b])) for k, a, b in spans]


def mask(text: bytes, spans) -> bytes:
    """The text with every span replaced by [kind]; overlapping spans become one, named after the first."""
    out, end = [], 0
    joined: list = []
    for kind, a, b in spans:
        if joined and a < joined[-1][2]:
            joined[-1][2] = max(b, joined[-1][2])
        else:
            joined.append([kind, a, b])
    for kind, a, b in joined:
        out += [text[end:a], f"[{kind}]".encode()]
        end = b
    return b"".join([*out, text[end:]])


def _line(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches):
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.slice(at, 512)
            out = []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                text = text or b""
                found = find_secrets(text)
                points = _points(text, found)
                base = [s for s in points if s[0] in KINDS[:3]]
                count = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                out.append((*count, hashlib.sha256(_line(base).encode()).hexdigest(), _line(points), mask(text, found) if found else None))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([
                *part.columns[1:], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3]), pa.array(cols[4]),
                pa.array(cols[5], pa.binary()).cast(pa.string()),
            ], names=[*part.schema.names[1:], "n_assign", "n_access", "n_hex", "base_sha256", "spans", "masked"])


def scan_secrets(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_assign, n_access, n_hex, base_sha256, spans, masked.

    ``spans`` is kind:start:end of every secret by start, then kind as in ``KINDS``, in code points with the
    end exclusive; ``base_sha256`` is the digest of the first three kinds' part.  ``masked`` is the text with
    each secret replaced by its kind in brackets, null if there is none.  A null or empty text has none.
    Repeated rows are each judged.  A kept column may not carry the name of a result column.
    """
    df = importable(docs).select(F.col("text").cast("string").alias("text"), *[F.col(c) for c in keep])
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes[1:])
    return df.mapInArrow(_scan, f"{fields}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, masked string")

"""Contamination and secrets against plain re-readings of their rules."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from gaugeline.llm import secrets as sec
from gaugeline.llm.decontamination import find_contamination, normal_words
from gaugeline.sources.tables import table


def lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def brute_hits(docs, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns = set()
    for i, t in items:
        w = word.findall(lower(t))
        if i is not None and w:
            patterns |= {(str(i), tuple(w[k:k + size])) for k in range(max(1, len(w) - size + 1))}
    out = []
    for d, t in docs:
        w = word.findall(lower(t))
        hit, found = set(), set()
        for i, p in patterns:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found.add(i)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_brute_force(spark, documents):
    rnd = random.Random(1)
    w = [f"w{i}" if i % 3 else f"É{i}ß" for i in range(40)]
    text = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    items = [(i, text(rnd.randrange(1, 30))) for i in range(12)] + [(50, "one two"), (51, "ONE-two"), (52, ""), (53, None), (54, "..."), (None, "w1"), (12, "x" * 50)]
    items += [(9, items[9][1])]
    docs = [(i, text(rnd.randrange(40)) + "; " + (items[i % 12][1] or "").upper().replace(" ", " -\n") + " " + text(rnd.randrange(9))) for i in range(40)]
    docs += [(60, "say one, Two!"), (61, "onetwo"), (62, None), (63, ""), (64, "xone two"), (65, "one two " * 3000), (65, "one two " * 3000), (None, "one two")]
    df = documents([(d, t, "s") for d, t in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(df, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_hits(docs, items)
    none = find_contamination(df, bench.limit(0)).where("contaminated").count()
    assert none == 0 and find_contamination(df.limit(0), bench).count() == 0


def test_contamination_blocks_and_offsets(spark, documents, monkeypatch):
    from gaugeline.llm import decontamination as dc

    docs = documents([(1, "Ä: The QUICK brown,fox é", "s")])
    items = spark.createDataFrame([(1, "quick brown"), (2, "brown fox"), (3, "never here")], "item_id long, text string")
    for size in (1, 1 << 20):
        monkeypatch.setattr(dc, "BLOCK_BYTES", size)
        row = dc.find_contamination(docs, items).first()
        assert row["items"] == ["1", "2"] and [tuple(s) for s in row.spans] == [(7, 22)]
        assert "Ä: The QUICK brown,fox é"[7:22] == "QUICK brown,fox"


def test_more_items_than_a_pass_holds(spark, documents, monkeypatch):
    from gaugeline.llm import decontamination as dc

    rnd = random.Random(4)
    text = lambda n: " ".join(f"w{rnd.randrange(25)}" for _ in range(n))
    items = [(i, text(rnd.randrange(1, 14))) for i in range(9)] + [(3, "w1 w2")]
    docs = [(i, text(rnd.randrange(60))) for i in range(30)] + [(3, text(20)), (None, "w1 w2"), (40, None), (41, "")]
    df = documents([(d, t, "s") for d, t in docs]).withColumns({"runs": F.lit(1), "__text": F.col("text")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_BYTES", 1)
    keep = ("doc_id", "text", "runs", "__text")
    whole = sorted(map(str, find_contamination(df, bench, keep=keep).collect()))
    monkeypatch.setattr(dc, "PASS_BYTES", 200)
    assert sum(1 for _ in dc._passes(dc.item_blocks(bench))) > 2
    got = find_contamination(df, bench, keep=keep)
    assert sorted(map(str, got.collect())) == whole
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute_hits(docs, items)


def test_six_blocks_build_six_automata_a_chunk(monkeypatch):
    import types

    import pyarrow as pa
    from gaugeline.llm import decontamination as dc

    built = []
    monkeypatch.setattr(dc, "_automata", {})
    monkeypatch.setattr(dc, "windows", lambda words, size: built.append(words) or [b" ".join(words)])
    blocks = [(str(i), types.SimpleNamespace(value=dc._packed([(str(i), b"w%d x" % i)])[1])) for i in range(6)]
    n = 50
    batch = pa.RecordBatch.from_arrays([
        pa.array([f"a w{i % 7} x b" for i in range(n)]), pa.array([[]] * n, dc.RUNS), pa.array([[]] * n, pa.list_(pa.string())),
        pa.array(range(n))], names=["__scan", "__runs", "__items", "doc_id"])
    out = pa.Table.from_batches(list(dc._scanner(blocks, 10, True)(iter([batch]))))
    assert len(built) == 6
    assert out["n_hit"].to_pylist() == [2 if i % 7 < 6 else 0 for i in range(n)]
    assert out["items"].to_pylist() == [[str(i % 7)] if i % 7 < 6 else [] for i in range(n)]
    built.clear()
    monkeypatch.setattr(dc, "_automata", {})
    monkeypatch.setattr(dc, "CHUNK_BYTES", 100)  # chunks of ten texts, four automata kept
    again = pa.Table.from_batches(list(dc._scanner(blocks, 10, True)(iter([batch]))))
    assert again == out and len(built) > 6


def test_normal_words_keep_all_non_ascii_bytes():
    assert normal_words("a b\u0085c d_E\x1f9".encode()) == ["a".encode(), "b\u0085c d".encode(), b"e", b"9"]


BASE = [("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def brute_secrets(t):
    out = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(t or "") if len(m[group]) >= least]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_secrets_brute_force(spark, documents):
    rnd = random.Random(2)
    parts = ["token", "=", " ", "Password", "passwd:", "secret", "'", '"', "api_key", "APIKEY", ": ", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "akia",
             "é", "ſecret=abcdefgh", "Key", "\n", "deadbeef" * 3, "x", "0", "toKen = ", "_", "."]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(30))), "s") for i in range(600)]
    rows += [(700, None, "s"), (701, "", None), (702, "f" * 100_000, "s"), (703, "token=" * 5000 + "abc", "s"), (703, "token=" * 5000 + "abc", "s")]
    rows += [(r.doc_id + 1000, r.text, r.source) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = {}
    for r in sec.scan_secrets(documents(rows)).collect():
        got.setdefault(r.doc_id, r)
    assert len(got) == len({r[0] for r in rows})
    for d, t, _ in rows:
        want = brute_secrets(t)
        r = got[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in ("assign", "access", "hex")] == (line.split(",") if line else [])
        assert (r.masked is None) == (r.spans == "")
    assert sec.scan_secrets(documents([])).count() == 0


def test_checksums():
    body = "0123456789abcdefghijABCDEFGHIJ"
    good = sec.checksum(body.encode()).decode()
    bad = "0" * 6 if good != "0" * 6 else "1" * 6
    for head, kind in (("ghp_", "github"), ("npm_", "npm")):
        text = f"é {head}{body}{good} {head}{body}{bad}".encode()
        assert sec.find_secrets(text) == [(kind, 3, 3 + 4 + 36)]
    assert sec.mask(b"a token=abcdef0123456789abcdef0123 b", sec.find_secrets(b"a token=abcdef0123456789abcdef0123 b")) == b"a [assign] b"

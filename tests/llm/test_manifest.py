"""Manifest: trees, proofs and ranks against a plain recursion over sorted rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeline.llm.manifest import fold, manifest, proof_hash, steps_of, without_line_ends


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, by sorting."""
    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            first = i - i % 3
            out.append((nodes[first:i], nodes[i + 1:first + 3]))
            i //= 3
        return out

    groups = {}
    for r in rows:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        other = r["text"].replace("\n", "") if hit and r["text"] is not None else r["text"]
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf_of(r, r["text"]), leaf_of(r, other)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    above = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (d, leaf, other) in enumerate(groups[s]):
            steps = path(trees[s], i) + path(above, k)
            h = other
            for a, b in steps:
                h = sha("".join([*a, h, *b]))
            root = above[-1][0]
            out.append((d, leaf, trees[s][-1][0], root, sha("".join("".join(a + b) for a, b in steps)), h, h == root))
    return sorted(out, key=str)


def run(docs, **more):
    leaf, other = without_line_ends(docs)
    return manifest(docs.select("doc_id", "source", leaf.alias("leaf"), other.alias("other")), **more)


def check(docs, **more):
    got = run(docs, **more).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain([r.asDict() for r in docs.collect()])


def rows(n, source=lambda i: f"s{i % 3}", ids=lambda i: i):
    return [(ids(i), f"line {i}\nmore\n" if i % 4 else (None if i % 8 else ""), source(i)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 4, 28])
def test_small_trees(documents, n):
    check(documents(rows(n, lambda i: "only")))


def test_many_groups(documents):
    check(documents(rows(60, lambda i: None if i % 7 == 0 else "" if i % 7 == 1 else f"é{i % 5}")))


def test_several_steps_and_directories(documents):
    """Blocks of 9 and directories of 16 entries make many steps of what are one or two."""
    check(documents(rows(300, lambda i: "big" if i % 3 else f"s{i % 20}", lambda i: (i * 7919) % 100_000 - 50_000)), levels=2, span=4)


def test_any_ids(documents):
    ids = [0, -1, 63, 64, 65, 1 << 40, -(1 << 40), 5]
    check(documents([(i, f"t{i}", "a") for i in ids] + [(None, "x", "a"), (None, "y\n", "a"), (None, "x", None)]))


def test_repeated_rows(documents):
    check(documents(rows(20) + [(5, "other", "s2"), (5, "other", "s2"), (5, None, "s2"), (5, "z", "s1"), *rows(3)]))


def test_proof_leads_to_the_root_and_changes_are_seen(documents):
    docs = documents(rows(50))
    got = run(docs, with_proof=True).collect()
    for r in got:
        steps = steps_of(bytes(r["proof"]))
        assert fold(bytes.fromhex(r["leaf"]), steps).hex() == r["root"] and proof_hash(bytes(r["proof"])) == r["proof_sha256"]
        assert r["verified"] == (r["folded_root"] == r["root"])
    hit = {r["doc_id"]: r["verified"] for r in got}
    for r in docs.collect():
        lost = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (r["text"] or "")
        assert hit[r["doc_id"]] == (not lost)


def test_places_are_ranks(documents):
    got = run(documents(rows(100, lambda i: "a", lambda i: 1000 - 3 * i))).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["place"])] == sorted(1000 - 3 * i for i in range(100))


def test_empty_table_and_clashing_names(documents):
    assert run(documents([])).collect() == []
    docs = documents(rows(5)).withColumn("leaf", F.lit(1)).withColumn("root", F.lit(2)).withColumn("place", F.lit(3)).withColumn("__id", F.lit(4))
    check(docs.select("doc_id", "text", "lang", "source", "n_chars", "leaf", "root", "place", "__id"))

"""Packing: ids against the tokenizer itself, bins against brute force, exact round trip."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import packing
from gaugeline.llm.packing import Encoder, Slack, pack_documents, plan_bins, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "it's I'M don't 'S'T we'LL'd ''s 're're x' '", "<|endoftext|>x<|", "a\x1cy\x85z\xa0q é é ́k", "ΑΣ ΑΣ. 中文 naïve ÉÀÿŸßẞ İſ ×÷ µ½", "12a\n\n3\x0b\x0ctab\t_a__9", "\x00\x7f"]


def ids_of(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("segment,parts", [(1 << 20, 1 << 20), (40, 1 << 20), (200, 20)])
def test_ids_are_those_of_the_tokenizer(monkeypatch, segment, parts):
    monkeypatch.setattr(packing, "SEGMENT", segment)
    monkeypatch.setattr(packing, "PARTS", parts)
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in range(0x180)] + list("'stredvml  SAéÉ9_.") * 12
    texts = ODD + ["".join(rng.choice(letters, 60)) for _ in range(400)]
    found = [ids.tolist() for _, ids in Encoder(PATH).texts(pa.array(texts))]
    assert found == ids_of(texts)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    assert [i.tolist() for _, i in Encoder(path).texts(pa.array(ODD))] == [t.encode(x, add_special_tokens=False).ids for x in ODD]


def fewest(lengths, capacity):
    """Fewest bins, by trying all ways."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:j]:
                put(i + 1, rooms[:j] + [room - lengths[i]] + rooms[j + 1:])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def test_a_bin_is_the_fullest_combination():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(1, 40, rng.integers(1, 9)).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        seed = max(lengths)
        rest = sorted(lengths)[:-1]
        sums = [seed + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)]
        found = Slack(counts, 40).fullest(seed)
        assert sum(n * k for n, k in found.items()) == max(s for s in sums if s <= 40)
        assert all(k <= counts[n] for n, k in found.items()) and found[seed] >= 1


def test_bins_hold_everything_and_are_few():
    rng = np.random.default_rng(2)
    more = total = 0
    for _ in range(60):
        lengths = rng.integers(1, 25, rng.integers(1, 9)).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        steps = plan_bins(counts, 25)
        held = [n for times, bin_ in steps for n, k in bin_.items() for _ in range(k * times)]
        assert sorted(held) == sorted(lengths) and all(sum(n * k for n, k in b.items()) <= 25 for _, b in steps)
        total += fewest(lengths, 25)
        more += sum(t for t, _ in steps) - fewest(lengths, 25)
    assert more <= 0.03 * total
    large = {n: int(c) for n, c in zip(range(1, 2048), rng.integers(0, 1000, 2047))}
    steps = plan_bins(large, 2048)
    assert sum(t for t, _ in steps) <= 1.015 * sum(n * c for n, c in large.items()) / 2048 and len(steps) < 20_000


def test_one_step_takes_a_combination_as_often_as_it_stays_the_best():
    """The steps are those of a search that goes bin by bin."""
    counts = {3: 7, 4: 9, 5: 2, 7: 3, 10: 4}
    slack, single = Slack(dict(counts), 12), []
    for seed in sorted(counts, reverse=True):
        while slack.left[seed]:
            b = slack.fullest(seed)
            slack.remove(b, 1)
            single.append(b)
    assert [b for t, b in plan_bins(counts, 12) for _ in range(t)] == single


def test_round_trip(documents):
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice(["heron", "ationt", "x9", "don't", "é"], 3000))
    rows = [(1, None, "a"), (2, "", "a"), (3, long, "b"), (4, "one two", None), (4, "one two", None), (None, "three", "b"),
            *[(10 + i, " ".join(rng.choice(["heron", "ab", "c"], rng.integers(1, 90))), "a") for i in range(80)]]
    packed = pack_documents(documents(rows), PATH, 64, with_ids=True)
    got = [r.asDict() for r in packed.collect()]
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    by_doc = {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) and r["start"] == 64 * r["piece"]
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d, text, _ in rows:
        pieces = sorted(by_doc[d], key=lambda r: r["piece"])
        if d != 4:
            assert sum((r["ids"] for r in pieces), []) == ids_of([text or ""])[0] + [0] and all(r["length"] == 64 for r in pieces[:-1])
    assert len(by_doc[4]) == 2 and len({(r["sequence_id"], r["offset"]) for r in by_doc[4]}) == 2
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.1 * sum(r["length"] for r in got) / 64 + 1
    whole = {r["sequence_id"]: r for r in sequences(packed.select("doc_id", *packed.columns[1:])).collect()}
    for r in got:
        assert whole[r["sequence_id"]]["ids"][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_many_alike_over_many_tasks(documents):
    """A length that nearly all rows share gets its ranks from every task."""
    packed = pack_documents(documents([(i, "", "a") for i in range(1000)]).repartition(7), PATH, 64)
    rows = packed.collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 1000 and len({r["sequence_id"] for r in rows}) == 16


def test_empty_table(documents):
    assert pack_documents(documents([]), PATH).collect() == []

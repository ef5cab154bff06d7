"""Language-model scoring: a Katz backoff bigram model over word tokens.

Tables, all counted over every training text:
  words     (word, c): 64-bit hashes of the lower-cased words.
  bigrams   rows of (part, pairs, counts): sorted pairs of vocabulary numbers, in blocks of one part each.
  histories denominator and backoff weight by vocabulary number.

The vocabulary are all words with at least ``min_count`` occurrences, numbered by rank.  All rarer and
all unseen words are members of the class <unk>, which a bigram sees as one word; a member's share of the
class comes from its own count.

The numbers of the ``CACHED`` most frequent words, at most, are broadcast.  Where the vocabulary is larger, the others
are numbered in a table: pairs with a word that isn't cached go out under its hash and are joined with that table, their
histories' denominators and weights come from the part's own block.  ``CACHED`` does not change a result.

Discounts are Good-Turing for counts up to 5, at both orders.  A word w after h has
    P(w | h) = d(c) c(h, w) / n(h)    if the pair was seen, else
    P(w | h) = backoff(h) P(w),       backoff(h) = (1 - sum of seen P(. | h)) / (1 - sum of their P(.)),
so each history sums to 1 exactly, and P(w) = d(c) c(w) / N with the rest left to unseen words.

Pairs are dealt into parts by a hash of the history, those of a frequent history by one of the pair.
The most frequent pairs (at most ``FREQUENT``, as each holds that share of all tokens) are
broadcast and scored where the text is read, so no pair can fill a part.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm import words as W
from gaugeline.llm.workers import importable
from gaugeline.sources.tables import stored

CACHED = 1 << 19
FREQUENT = 1 << 16
PER_PART = 2_000_000
START, END, UNKNOWN, FIRST = 0, 1, 2, 3
MOST = 5  # counts above are not discounted
FLUSH = 4_000_000


def in_fold(doc_id) -> F.Column:
    """crc32(doc_id as text) mod 5 = 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def good_turing(of_counts: dict) -> np.ndarray:
    """Factor for the counts 0 .. MOST + 1, from the number of types by count.

    Katz's formula where it gives a factor between 0 and 1 that leaves the order of counts; else
    absolute discounting by n1 / (n1 + 2 n2); 1 above ``MOST``.
    """
    n = [0] + [of_counts.get(r, 0) for r in range(1, MOST + 2)]
    out = np.ones(MOST + 2)
    off = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    for r in range(1, MOST + 1):
        d = -1.0
        if all(n[1:]):
            a = (MOST + 1) * n[MOST + 1] / n[1]
            if a < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a)
        out[r] = d if 0 < d < 1 else (r - off) / r
    return np.clip(out, 1e-3, 1.0)


def discounted(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return counts * factor[np.minimum(counts, MOST + 1)]


def _sums(at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Sums by index, as floats even where there is nothing to add."""
    return np.bincount(at, weights=value, minlength=n).astype(np.float64)


def _count_words(batches):
    """(word, count) of the training texts, summed over what a task has read so far."""
    held, size = [], 0

    def sums():
        w, c = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
        names, turn = np.unique(w, return_inverse=True)
        return names, np.bincount(turn, weights=c, minlength=len(names)).astype(np.int64)

    for batch in batches:
        for _, data, bounds in W.pieces(batch.column(0)):
            names, counts = np.unique(W.words(data, bounds)[0], return_counts=True)
            held.append((names, counts))
            size += len(names)
            if size > FLUSH // 4:
                held = [sums()]
                size = len(held[0][0])
                if size > FLUSH // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "c"])
                    held, size = [], 0
    if held:
        names, counts = sums()
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(counts)], names=["word", "c"])


class Model:
    """What tasks need of the bounded tables: the cached words, unigram values, and by cached number denominators and weights.

    ``steps`` are the vocabulary's counts, falling, and how many words have them: a word's number tells its count.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, types: int, ends: int, factor: np.ndarray, seen_mass: float, steps: tuple):
        rank = np.lexsort((words, -counts))
        words, counts = words[rank], counts[rank]
        self.order = np.argsort(words)
        self.sorted, self.total, self.types, self.ends, self.factor = words[self.order], total, types, ends, factor
        self.count = np.concatenate([[0, ends, 0], counts])
        # the mass of unseen words; a corpus without rare words leaves one part in N + 1
        self.scale = 1.0 if seen_mass < 1 - 1e-12 else total / (total + 1.0)
        p = self.scale * discounted(self.count, factor) / max(total, 1)
        self.unseen = 1.0 - self.scale * seen_mass
        self.step, self.upto = steps[0], np.cumsum(steps[1])
        in_vocabulary = self.scale * (discounted(steps[0], factor) * steps[1]).sum() / max(total, 1)
        p[UNKNOWN] = max(1.0 - p[END] - in_vocabulary, 1e-300)
        self.wide = bool(len(self.upto)) and int(self.upto[-1]) > len(words)
        self.p = p
        with np.errstate(divide="ignore"):
            self.logp = np.log10(p)

    def base(self, counts):
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.types + 1)))

    def base_of(self, c: F.Column) -> F.Column:
        return F.log10((c + 0.5) / F.lit(self.total + 0.5 * (self.types + 1)))

    def member_of(self, c: F.Column) -> F.Column:
        """log10 of the share of <unk> of a rare word with that training count, 0: unseen."""
        factor = F.lit(1.0)
        for r in range(1, MOST + 1):
            factor = F.when(c == r, float(self.factor[r])).otherwise(factor)
        p = F.when(c > 0, factor * c * F.lit(self.scale / max(self.total, 1))).otherwise(F.lit(float(self.unseen)))
        return F.log10(F.greatest(p / F.lit(float(self.p[UNKNOWN])), F.lit(1e-300)))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of word hashes."""
        if not len(self.sorted):
            return np.full(len(words), UNKNOWN)
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.order[at] + FIRST, UNKNOWN)

    def prob(self, number: np.ndarray) -> np.ndarray:
        """P of vocabulary numbers, cached or not."""
        size = len(self.p)
        out = self.p[np.minimum(number, size - 1)]
        far = number >= size
        if far.any():
            count = self.step[np.searchsorted(self.upto, number[far] - FIRST, "right")]
            out[far] = self.scale * discounted(count, self.factor) / max(self.total, 1)
        return out

    def far_pairs(self, data, bounds):
        """(before, after, text) of the pairs with a word that isn't cached: its hash in place of a number."""
        word, number, text, pair, owner, far = self.pairs(data, bounds)
        token = (pair & np.uint64(0xFFFFFFFF)).copy()
        is_word = np.ones(len(token), bool)
        is_word[np.cumsum(np.bincount(text, minlength=len(bounds) - 1) + 1) - 1] = False
        token[is_word] = np.where(number == UNKNOWN, word, number.astype(np.uint64))
        before = pair >> np.uint64(32)
        before[1:] = np.where(before[1:] == START, before[1:], token[:-1])
        return before[far], token[far], owner[far]

    def pairs(self, data, bounds):
        """(word hash, number, text) of all words; (pair, text, whether a word's number is still to be found) of all tokens, the end included."""
        word, text, _, _ = W.words(data, bounds)
        number, n = self.numbers(word), len(bounds) - 1
        count = np.bincount(text, minlength=n)
        last = np.cumsum(count + 1) - 1  # place of each text's end among all tokens
        token = np.full(len(word) + n, END)
        is_word = np.ones(len(token), bool)
        is_word[last] = False
        token[is_word] = number
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[np.concatenate([[0], last[:-1] + 1])[:n]] = START
        owner = np.repeat(np.arange(n), count + 1)
        far = (token == UNKNOWN) | (before == UNKNOWN) if self.wide else np.zeros(len(token), bool)
        return word, number, text, before.astype(np.uint64) << np.uint64(32) | token.astype(np.uint64), owner, far

    def part(self, pair: np.ndarray, parts: int) -> np.ndarray:
        before = pair >> np.uint64(32)
        often = np.append(self.count >= max(self.total / parts / 8, 1), False)  # the last: all that aren't cached
        often[[START, UNKNOWN]] = True
        return (W.mix(np.where(often[np.minimum(before.astype(np.int64), len(self.count))], pair, before)) % np.uint64(parts)).astype(np.int32)


def _pack(x: np.ndarray) -> bytes:
    """Unsigned values, byte plane by byte plane, compressed; the size goes first."""
    x = x.astype(np.uint64)
    wide = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()
    return len(x).to_bytes(8, "little") + wide.to_bytes(1, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n, wide = int.from_bytes(b[:8], "little"), b[8]
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :wide] = np.frombuffer(pa.decompress(b[9:], n * wide, codec="zstd", asbytes=True), np.uint8).reshape(wide, n).T
    return out.view(np.uint64).reshape(-1)


def _pack_pairs(pair):
    return _pack(pair >> np.uint64(32)), _pack(pair & np.uint64(0xFFFFFFFF))


def _unpack_pairs(a, b):
    return _unpack(a) << np.uint64(32) | _unpack(b)


def _count_pairs(model, parts):
    """Rows (part, before, after, counts) of the training pairs, summed over a few million tokens."""
    def run(batches):
        held, size = [], 0

        def rows():
            return _packed_counts(model.value, parts, *np.unique(np.concatenate(held), return_counts=True))

        for batch in batches:
            for _, data, bounds in W.pieces(batch.column(0)):
                _, _, _, pair, _, far = model.value.pairs(data, bounds)
                held.append(pair[~far])
                size += len(held[-1])
                if size > FLUSH:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    return run


def _packed_counts(model, parts, pair, count) -> pa.RecordBatch:
    """Rows (part, before, after, counts) of different pairs in rising order."""
    part, found = model.part(pair, parts), []
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
    for a, b in zip(cut[:-1], cut[1:]):
        own = order[a:b]
        found.append((int(part[own[0]]), *_pack_pairs(pair[own]), _pack(count[own])))
    cols = list(zip(*found)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                      names=["part", "before", "after", "counts"])


def _far_rows(model, keyed):
    """Rows (row, before, after, n) of the pairs with a word that isn't cached, summed over a few million bytes; without ``keyed`` row is 0."""
    def run(batches):
        held, size = [], 0

        def rows():
            row, before, after = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((after, before, row))
            row, before, after = row[order], before[order], after[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1]) | (after[1:] != after[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(row)))
            return pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(before[at].view(np.int64)), pa.array(after[at].view(np.int64)), pa.array(n)], names=["row", "before", "after", "n"])

        for batch in batches:
            for at, data, bounds in W.pieces(batch.column(0)):
                before, after, owner = model.value.far_pairs(data, bounds)
                key = batch.column("row").to_numpy()[at:at + len(bounds) - 1] if keyed else np.zeros(len(bounds) - 1, np.int64)
                held.append((key[owner], before, after))
                size += len(before)
                if size > FLUSH // 4:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    return run


def _numbered(pairs: DataFrame, numbers: DataFrame, size: int) -> DataFrame:
    """Pairs with their words' hashes replaced by numbers, <unk> for words outside the vocabulary.

    A cached side is dealt by a hash of the pair, so a frequent word fills no task.
    """
    for side in ("before", "after"):
        far = (F.col(side) < 0) | (F.col(side) >= size)
        keyed = pairs.withColumn("word", F.when(far, F.col(side)).otherwise(F.xxhash64("before", "after", "row")))
        pairs = keyed.join(numbers, "word", "left").withColumn(side, F.when(far, F.coalesce("number", F.lit(UNKNOWN))).otherwise(F.col(side))).drop("word", "number")
    return pairs


def _pair_of(batch):
    return batch.column("before").to_numpy().astype(np.uint64) << np.uint64(32) | batch.column("after").to_numpy().astype(np.uint64)


def _count_far(model, parts):
    """Rows of the bigram table from pairs under numbers."""
    def run(batches):
        held, size = [], 0

        def rows():
            pair, n = (np.concatenate(x) for x in zip(*held))
            names, turn = np.unique(pair, return_inverse=True)
            return _packed_counts(model.value, parts, names, np.bincount(turn, weights=n, minlength=len(names)).astype(np.int64))

        for batch in batches:
            held.append((_pair_of(batch), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size > FLUSH // 4:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    return run


def _number_rest(words: DataFrame, min_count: int, least: int, cached: int) -> DataFrame:
    """(word, number) of the vocabulary that isn't cached, numbered on by falling counts; numbers stay below 2^32."""
    rest = words.where(f"c >= {min_count} AND c < {least}").orderBy(F.desc("c"), "word")
    rest = stored(rest.select("word", F.monotonically_increasing_id().alias("id")), "numbers")
    place, at = F.shiftright("id", 33), FIRST + cached
    sizes, starts = sorted(tuple(r) for r in rest.groupBy(place.alias("place")).count().collect()), []  # a row a file
    for p, n in sizes:
        starts.append((int(p), at))
        at += n
    starts = words.sparkSession.createDataFrame(starts, "place long, start long")
    rest = rest.withColumn("place", place).join(F.broadcast(starts), "place")
    return rest.select("word", (F.col("start") + F.col("id").bitwiseAND((1 << 33) - 1)).alias("number"))


def _sum_pairs(table: pa.Table) -> pa.Table:
    """One block of the bigram table from all rows of its part."""
    pair = np.concatenate([_unpack_pairs(a, b) for a, b in zip(table.column("before").to_pylist(), table.column("after").to_pylist())])
    count = np.concatenate([_unpack(c) for c in table.column("counts").to_pylist()])
    names, turn = np.unique(pair, return_inverse=True)
    before, after = _pack_pairs(names)
    sums = _pack(np.bincount(turn, weights=count, minlength=len(names)).astype(np.uint64))
    return pa.table({"part": table.column("part").slice(0, 1), "before": pa.array([before], pa.binary()), "after": pa.array([after], pa.binary()), "counts": pa.array([sums], pa.binary())})


def _blocks(batch):
    for a, b, c in zip(batch.column("before").to_pylist(), batch.column("after").to_pylist(), batch.column("counts").to_pylist()):
        yield _unpack_pairs(a, b), _unpack(c).astype(np.int64)


def _counts_of_counts(batches):
    for batch in batches:
        for _, count in _blocks(batch):
            r, n = np.unique(count[count <= MOST + 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(n)], names=["r", "n"])


def _history_sums(model, factor):
    def run(batches):
        for batch in batches:
            for pair, count in _blocks(batch):
                cached = pair >> np.uint64(32) < len(model.value.count)
                names, *sums = _by_history(model.value, pair[cached], count[cached], factor)
                yield pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(x) for x in sums]], names=["h", "n", "seen", "lower"])

    return run


def _by_history(model, pair, count, factor):
    """(history, tokens, discounted tokens, lower order's mass of what was seen)."""
    before, after = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
    names, turn = np.unique(before, return_inverse=True)
    return names, *[_sums(turn, x, len(names)) for x in (count, discounted(count, factor), model.prob(after))]


def _weights(n, seen, lower):
    """(denominator, backoff weight) of histories."""
    # nothing left for unseen words: one more in the denominator; nothing unseen: the seen ones share all
    n = np.where((n - seen < 1e-9) & (lower < 1 - 1e-12), n + 1, n)
    all_seen = lower >= 1 - 1e-12
    n = np.where(all_seen, seen, n)
    return n, np.where(all_seen, 0.0, np.maximum(1 - seen / n, 0) / np.maximum(1 - lower, 1e-300))


def _frequent(least):
    def run(batches):
        for batch in batches:
            for pair, count in _blocks(batch):
                own = count >= least
                yield pa.RecordBatch.from_arrays([pa.array(pair[own].view(np.int64)), pa.array(count[own])], names=["pair", "c"])

    return run


class Katz:
    """A fitted model: ``bigrams`` and ``words`` are tables, the rest is bounded and shared with tasks."""

    def __init__(self, words, bigrams, shared, parts, least, min_count, numbers):
        self.words, self.bigrams, self.shared, self.parts, self.least, self.min_count, self.numbers = words, bigrams, shared, parts, least, min_count, numbers


def fit(docs: DataFrame, min_count: int = 2) -> Katz:
    """Learn from all texts of ``docs``.  A null text is empty; an empty text has one token, the end."""
    spark = docs.sparkSession
    texts = importable(docs).select(F.col("text").cast("string").alias("text"))
    words = stored(texts.mapInArrow(_count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = texts.count()
    by_count = words.groupBy("c").agg(F.count("*").alias("n")).toArrow()  # as many rows as there are different counts
    c, n = by_count.column("c").to_numpy(), by_count.column("n").to_numpy()
    total, types = int((c * n).sum()) + ends, int(n.sum()) + (ends > 0)
    of_counts = dict(zip(c.tolist(), n.tolist()))
    of_counts[ends] = of_counts.get(ends, 0) + 1
    factor = good_turing(of_counts)
    seen_mass = float((n * discounted(c, factor)).sum() + discounted(np.array([ends]), factor)[0]) / max(total, 1)
    order = np.argsort(-c)
    order = order[c[order] >= min_count]
    fits = c[order][np.cumsum(n[order]) <= CACHED]
    least = int(fits.min()) if len(fits) else 1 << 62
    kept = words.where(F.col("c") >= least).toArrow()
    model = Model(kept.column("word").to_numpy().view(np.uint64), kept.column("c").to_numpy(), total, types, ends, factor, seen_mass, (c[order], n[order]))
    shared = spark.sparkContext.broadcast(model)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PER_PART))
    counted = texts.mapInArrow(_count_pairs(shared, parts), "part int, before binary, after binary, counts binary")
    numbers = None
    if model.wide:
        numbers = _number_rest(words, min_count, least, len(kept))
        far = _numbered(texts.mapInArrow(_far_rows(shared, False), "row long, before long, after long, n long"), numbers, len(model.count))
        counted = counted.unionByName(far.mapInArrow(_count_far(shared, parts), "part int, before binary, after binary, counts binary"))
    bigrams = stored(counted.groupBy("part").applyInArrow(_sum_pairs, "part int, before binary, after binary, counts binary"), "bigrams")
    rows = bigrams.mapInArrow(_counts_of_counts, "r long, n long").groupBy("r").agg(F.sum("n")).collect()
    pair_factor = good_turing({r: k for r, k in rows})
    sums = (bigrams.mapInArrow(_history_sums(shared, pair_factor), "h long, n double, seen double, lower double")
            .groupBy("h").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"), F.sum("lower").alias("lower")).toArrow())  # a row a cached number
    h, n, seen, lower = (sums.column(x).to_numpy() for x in ("h", "n", "seen", "lower"))
    size = len(model.count)
    model.denominator, model.backoff = np.ones(size), np.ones(size)
    model.denominator[h], model.backoff[h] = _weights(n, seen, lower)
    model.pair_factor = pair_factor
    often = bigrams.mapInArrow(_frequent(max(2, -(-total // FREQUENT))), "pair long, c long").toArrow()  # at most FREQUENT rows
    turn = np.argsort(often.column("pair").to_numpy().view(np.uint64))
    model.often, model.often_count = often.column("pair").to_numpy().view(np.uint64)[turn], often.column("c").to_numpy()[turn]
    shared.unpersist()
    return Katz(words, bigrams, spark.sparkContext.broadcast(model), parts, least, min_count, numbers)


def log_probability(model, pair: np.ndarray, count: np.ndarray, rest: tuple | None = None) -> np.ndarray:
    """``rest``: history numbers that aren't cached, with their denominators and weights.

    log10 P(after | before), with the pair's count: the discounted share if it was seen, else the backoff weight times the next lower order.
    """
    before, after = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
    size = len(model.count)
    near = np.minimum(before, size - 1)
    denominator, backoff = model.denominator[near], model.backoff[near]
    far = np.flatnonzero(before >= size)
    if len(far):
        names, n, weight = rest
        denominator[far], backoff[far] = 1.0, 1.0  # a word that was only seen last backs off in full
        if len(names):
            at = np.minimum(np.searchsorted(names, before[far]), len(names) - 1)
            has = names[at] == before[far]
            denominator[far[has]], backoff[far[has]] = n[at[has]], weight[at[has]]
    p = np.where(count > 0, discounted(count, model.pair_factor) / denominator, backoff * model.prob(after))
    return np.log10(np.maximum(p, 1e-300))


def _lookup(names, counts, pair):
    if not len(names):
        return np.zeros(len(pair), np.int64)
    at = np.minimum(np.searchsorted(names, pair), len(names) - 1)
    return np.where(names[at] == pair, counts[at], 0)


def _row_sums(shared):
    """Per text: token counts, base score and frequent pairs' score so far, and its rare words."""
    def run(batches):
        model = shared.value
        for batch in batches:
            for at, data, bounds in W.pieces(batch.column(0)):
                n = len(bounds) - 1
                word, number, text, pair, owner, far = model.pairs(data, bounds)
                common, rare = number != UNKNOWN, np.flatnonzero(number == UNKNOWN)
                tokens = np.bincount(owner, minlength=n)
                known = np.bincount(text[common], minlength=n) + (model.ends > 0)
                base = _sums(text[common], model.base(model.count[number[common]]), n) + model.base(model.ends)
                count = _lookup(model.often, model.often_count, pair)
                often = (count > 0) & ~far
                score = _sums(owner[often], log_probability(model, pair[often], count[often]), n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=n))]).astype(np.int32)), pa.array(word[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays([*[c.slice(at, n) for c in batch.columns[1:]], pa.array(tokens), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score), lists],
                                                 names=[*batch.schema.names[1:], "n_tokens", "n_known", "base", "score", "rare"])

    return run


def _pair_rows(shared, parts):
    """Rows (part, texts, sizes, before, after) of all pairs but the frequent ones, text by text, a few million pairs of a task at a time."""
    def rows(pairs, owners, keys):
        return _dealt(shared.value, parts, *(np.concatenate(x) for x in (pairs, owners, keys)))

    def run(batches):
        model, pairs, owners, keys, texts, size = shared.value, [], [], [], 0, 0
        for batch in batches:
            key = batch.column("row").to_numpy()
            for at, data, bounds in W.pieces(batch.column(0)):
                _, _, _, pair, owner, far = model.pairs(data, bounds)
                left = (_lookup(model.often, model.often_count, pair) == 0) & ~far
                pairs.append(pair[left])
                owners.append(owner[left] + texts)
                keys.append(key[at:at + len(bounds) - 1])
                texts, size = texts + len(bounds) - 1, size + len(pairs[-1])
                if size > FLUSH // 2:
                    yield rows(pairs, owners, keys)
                    pairs, owners, keys, texts, size = [], [], [], 0, 0
        if pairs:
            yield rows(pairs, owners, keys)

    return run


def _dealt(model, parts, pair, owner, key) -> pa.RecordBatch:
    """One row a part, from pairs and the place of their text among the keys."""
    names = ["part", "texts", "sizes", "before", "after"]
    part = model.part(pair, parts)
    order = np.lexsort((owner, part))
    cut = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        own = order[a:b]
        text, size = np.unique(owner[own], return_counts=True)
        out.append((int(part[own[0]]), key[text].tobytes(), _pack(size), *_pack_pairs(pair[own])))
    cols = list(zip(*out)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)


def _direct(model, pair, min_count):
    """(whether a pair is scored without its part's block, count): the frequent ones, and those with <unk> that training has none of."""
    count = _lookup(model.often, model.often_count, pair)
    before, after = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
    unseen = (min_count < 2) & ((before == UNKNOWN) | (after == UNKNOWN) & (before < len(model.count)))
    return (count > 0) & (before < len(model.count)) | unseen, count


def _far_scores(shared, min_count):
    """(row, score) of the numbered pairs that need no block."""
    def run(batches):
        for batch in batches:
            pair, n = _pair_of(batch), batch.column("n").to_numpy()
            own, count = _direct(shared.value, pair, min_count)
            keys, turn = np.unique(batch.column("row").to_numpy()[own], return_inverse=True)
            value = n[own] * log_probability(shared.value, pair[own], count[own])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(_sums(turn, value, len(keys)))], names=["row", "score"])

    return run


def _far_pair_rows(shared, parts, min_count):
    """Rows as of ``_pair_rows`` from the other numbered pairs."""
    def run(batches):
        held, size = [], 0

        def rows():
            pair, row = (np.concatenate(x) for x in zip(*held))
            key, owner = np.unique(row, return_inverse=True)
            return _dealt(shared.value, parts, pair, owner, key)

        for batch in batches:
            pair = _pair_of(batch)
            left = ~_direct(shared.value, pair, min_count)[0]
            n = batch.column("n").to_numpy()[left]
            held.append((np.repeat(pair[left], n), np.repeat(batch.column("row").to_numpy()[left], n)))
            size += len(held[-1][0])
            if size > FLUSH // 4:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    return run


def _part_scores(shared, parts):
    """A part's pairs against its block of the bigram table: rows (bucket, texts, sums).

    A text's bucket comes from its key alone, so all its sums meet in one bucket, whatever tasks its pairs went through.
    """
    def run(rows: pa.Table, table: pa.Table) -> pa.Table:
        model = shared.value
        names, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in table.to_batches():
            for names, counts in _blocks(b):
                pass
        far = names >> np.uint64(32) >= len(model.count)
        h, *sums = _by_history(model, names[far], counts[far], model.pair_factor)
        rest, keys, sums = (h, *_weights(*sums)), [np.zeros(0, np.int64)], [np.zeros(0)]
        for b in rows.to_batches():
            for t, s, x, y in zip(*(b.column(c).to_pylist() for c in ("texts", "sizes", "before", "after"))):
                pair, size = _unpack_pairs(x, y), _unpack(s).astype(np.int64)
                value = log_probability(model, pair, _lookup(names, counts, pair), rest)
                keys.append(np.frombuffer(t, np.int64))
                sums.append(np.add.reduceat(value, np.cumsum(size) - size))
        return _in_buckets(np.concatenate(keys), np.concatenate(sums), parts)

    return run


def _in_buckets(key, value, buckets) -> pa.Table:
    """One row a bucket that has texts; the keys and sums of its texts lie side by side."""
    bucket = (W.mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))  # the last is the end, also where there is no text
    ends = pa.py_buffer((cut * 8).astype(np.int32))
    blobs = [pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, ends, pa.py_buffer(x[order])]) for x in (key, value)]
    return pa.table({"bucket": pa.array(bucket[order][cut[:-1]]), "texts": blobs[0], "sums": blobs[1]})


def _text_scores(table: pa.Table) -> pa.Table:
    """Sums by text over all parts: one row a text of the bucket."""
    texts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(t, np.int64) for t in table.column("texts").to_pylist())])
    sums = np.concatenate([np.zeros(0), *(np.frombuffer(x) for x in table.column("sums").to_pylist())])
    names, turn = np.unique(texts, return_inverse=True)
    return pa.table({"row": names, "score": _sums(turn, sums, len(names))})


def score(docs: DataFrame, model: Katz) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, n_known, base_score, score (log10 of the text's probability).

    Every token is evaluated by the recursion in ``log_probability``; a member of <unk> adds its share of the class.
    Rows of equal id and text are scored together and returned as often as they come.
    """
    shared = model.shared
    base = importable(docs).select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"))
    fields = "doc_id long, row long, n_tokens long, n_known long, base double, score double, rare array<long>"
    rows = stored(base.mapInArrow(_row_sums(shared), fields), "rows")
    rare = rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    known = model.words.where(F.col("c") < model.least)

    own, c = shared.value, F.col("c")
    found = rare.join(known, "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    of_rare = found.groupBy("row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"), F.sum(F.col("n") * own.base_of(c)).alias("base"),
                                       F.sum(F.when(c < model.min_count, F.col("n") * own.member_of(c)).otherwise(0.0)).alias("score"))
    pairs = base.select("text", "row").mapInArrow(_pair_rows(shared, model.parts), "part int, texts binary, sizes binary, before binary, after binary")
    if own.wide:
        far = base.select("text", "row").mapInArrow(_far_rows(shared, True), "row long, before long, after long, n long")
        far = stored(_numbered(far, model.numbers, len(own.count)), "far")
        pairs = pairs.unionByName(far.mapInArrow(_far_pair_rows(shared, model.parts, model.min_count), pairs.schema))
    of_parts = pairs.groupBy("part").cogroup(model.bigrams.groupBy("part")).applyInArrow(_part_scores(shared, model.parts), "bucket int, texts binary, sums binary")
    of_pairs = of_parts.groupBy("bucket").applyInArrow(_text_scores, "row long, score double")
    none = [F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base")]
    summed = of_rare.select("row", "n_known", "base", "score").unionByName(of_pairs.select("row", *none, "score"))
    if own.wide:
        summed = summed.unionByName(far.mapInArrow(_far_scores(shared, model.min_count), "row long, score double").select("row", *none, "score"))
    summed = summed.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("n_known", "base", "score")])
    copies = rows.groupBy("row").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("doc_id", "n_tokens", "n_known", "base", "score")])
    out = copies.join(summed, "row", "left").withColumn("at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    def with_more(c):
        return F.col(c) + F.coalesce(F.col(f"more_{c}") / F.col("copies"), F.lit(0.0))

    return out.select("doc_id", "n_tokens", F.round(with_more("n_known")).cast("long").alias("n_known"), with_more("base").alias("base_score"), with_more("score").alias("score"))


def score_documents(docs: DataFrame, min_count: int = 2) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows outside the held-out fold, scores all.  Words of fewer than ``min_count`` occurrences are members of <unk>; with 1
    these are the words that training lacks.  With no training text every probability is 1.
    Extra columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    model = fit(docs.where(~in_fold(F.col("doc_id"))), min_count)
    out = score(docs, model)
    return out.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.shared.value.total).cast("long").alias("train_tokens"), "base_score", "score")

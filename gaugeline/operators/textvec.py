"""Vocabulary, TF-IDF, linear scoring, nearest example, 2-D maps.

Sparse vectors are rows (key, term, weight).  Terms are counted inside the row of
their document, so raw text is never shuffled; only counts and weights are.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeline.functions.frames import pinned
from gaugeline.functions.text import masked_tokens, ngrams_upto
from gaugeline.sources.tables import stored

#: Fixed value: texts counted at a time inside a task, few enough for the tables of their grams to stay in the processor's cache.
ARROW_ROWS = 500


def term_counts(docs: DataFrame, key: str, text: str, tokens=masked_tokens, n_max: int = 1, keep=()) -> DataFrame:
    """(key, term, tf) per row of ``docs``; terms are 1..n_max-grams, the key is unique.  The columns ``keep`` go with the key.

    The sorted terms of a row fall into runs of equal ones; a run's length is the count.
    """
    rows = pinned(docs.select(key, *keep, text), {"__t": tokens(F.col(text))}).select(key, *keep, "__t")
    terms = F.col("__t") if n_max == 1 else ngrams_upto(F.col("__t"), n_max)
    rows = pinned(rows, {"__s": F.sort_array(terms)}).select(key, *keep, "__s").where(F.size("__s") > 0)
    at = F.sequence(F.lit(0), F.size("__s") - 1)
    starts = F.filter(at, lambda i: (i == 0) | (F.get("__s", i) != F.get("__s", i - 1)))
    rows = pinned(rows, {"__i": starts})
    runs = F.transform("__i", lambda i, j: F.struct(
        F.get("__s", i).alias("term"), (F.coalesce(F.get("__i", j + 1), F.size("__s")) - i).cast("long").alias("tf")))
    return rows.select(key, *keep, F.inline(runs))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def gram_finder(n_max: int):
    """A function of a batch of token lists: its distinct 1..n_max-grams, and for every occurrence its row and its number among them.

    Words and then pairs of (gram so far, next word) are numbered by Arrow's hash tables, so text is joined once per distinct gram.
    It is made here so that it travels to the tasks whole.
    """
    def grams(tokens):
        words = tokens.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
        word = words.indices.to_numpy().astype(np.int64)
        words = words.dictionary
        at, gram, texts = np.arange(len(word)), word, words
        all_texts, rows, ids, known = [texts], [row], [word], len(texts)
        for n in range(2, n_max + 1):
            has = at + n - 1 < len(word)
            at, gram = at[has], gram[has]
            has = row[at] == row[at + n - 1]
            at, gram = at[has], gram[has]
            pairs = pa.array(gram * max(len(words), 1) + word[at + n - 1]).dictionary_encode()
            head, last = np.divmod(pairs.dictionary.to_numpy(), max(len(words), 1))
            texts = pc.binary_join_element_wise(texts.take(pa.array(head)), words.take(pa.array(last)), " ")
            gram = pairs.indices.to_numpy().astype(np.int64)
            all_texts.append(texts)
            rows.append(row[at])
            ids.append(gram + known)
            known += len(texts)
        same = pa.concat_arrays(all_texts).dictionary_encode()  # a token that holds a blank may equal a pair
        return same.dictionary, np.concatenate(rows), same.indices.to_numpy().astype(np.int64)[np.concatenate(ids)]

    return grams


def term_statistics(docs: DataFrame, text: str, tokens=masked_tokens, n_max: int = 1) -> DataFrame:
    """``document_frequency`` of the ``term_counts`` of ``docs``: terms are counted in Arrow batches, so a shuffled row is a term of a task and not of a document."""
    grams = gram_finder(n_max)

    def count(batches):
        for batch in batches:
            for at in range(0, len(batch), ARROW_ROWS):
                terms, row, term = grams(batch.column(0).slice(at, ARROW_ROWS))
                held = pc.unique(pa.array(row * max(len(terms), 1) + term)).to_numpy() % max(len(terms), 1)
                df, total = (pa.array(np.bincount(x, minlength=len(terms))) for x in (held, term))
                yield pa.RecordBatch.from_arrays([terms, df, total], names=["term", "df", "total"])

    seen = docs.select(tokens(F.col(text)).alias("t")).mapInArrow(count, "term string, df long, total long")
    return seen.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(df_table: DataFrame, size: int | None = 3000, min_df: int = 2, order="df") -> DataFrame:
    """Most frequent terms, ties by term; at most ``size`` rows, all terms with None."""
    known = df_table.where(F.col("df") >= min_df)
    return known if size is None else known.orderBy(F.desc(order), "term").limit(size)


def with_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    return vocab.withColumn("idf", F.ln((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def raw_weights(counts: DataFrame, idf: DataFrame, key: str, capped: bool = False) -> DataFrame:
    """tf * idf.  ``capped`` says that the vocabulary has a fixed cap, so it may be broadcast; else Spark decides by size."""
    idf = idf.select("term", "idf")
    return counts.join(F.broadcast(idf) if capped else idf, "term").select(
        key, "term", (F.col("tf") * F.col("idf")).alias("weight"))


def normalised(weights: DataFrame, key: str) -> DataFrame:
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return weights.withColumn("weight", F.col("weight") / norm)


def top_terms(weights: DataFrame, key: str, k: int) -> DataFrame:
    """The k heaviest terms per document with L2-normalised weights.

    A document has at most vocabulary-size terms, so they fit in its row.
    """
    item = F.struct((-F.col("weight")).alias("neg"), "term")
    rows = weights.groupBy(key).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        F.slice(F.array_sort(F.collect_list(item)), 1, k).alias("top"))
    out = rows.select(key, "norm", F.posexplode("top").alias("pos", "t"))
    return out.select(key, (F.col("pos") + 1).alias("rank"), F.col("t.term").alias("term"),
                      (-F.col("t.neg") / F.col("norm")).alias("weight"))


def log_odds_model(counts: DataFrame, docs: DataFrame, key: str, label: str, classes, min_df: int = 2):
    """A linear model table: per term that ``min_df`` documents share its idf and one coefficient column per class.

    Coefficients are smoothed log odds of a term inside against outside the class; intercepts are log class shares.
    ``counts`` are the terms of ``docs`` with their label, so document frequency and class counts come from one
    aggregation and no count is moved to meet its label.  Rows of one key share their labels; only such keys are looked up.
    Rows without a key count for the idf alone.
    """
    size = F.struct(F.count("*").alias("all"), *[F.count_if(F.col(label) == c).alias(c) for c in classes])
    total = docs.agg(size).scalar()  # one subquery for all class sizes
    n_all, sizes = total["all"], {c: total[c] for c in classes}
    owners = docs.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("__n"), *[F.count_if(F.col(label) == c).alias(f"__n_{c}") for c in classes])
    rows = counts.join(stored(owners.where("__n > 1"), "owners"), key, "left")
    has = F.col(key).isNotNull()
    seen = rows.groupBy("term").agg(
        F.count("*").alias("df"), F.sum(F.when(has, F.coalesce("__n", F.lit(1))).otherwise(0)).alias("__df"),
        *[F.sum(F.when(has, F.coalesce(f"__n_{c}", F.when(F.col(label) == c, 1).otherwise(0))).otherwise(0)).alias(f"df_{c}") for c in classes])
    coefs = []
    for c in classes:
        inside = F.ln((F.col(f"df_{c}") + 1.0) / (sizes[c] + 2.0))
        outside = F.ln((F.col("__df") - F.col(f"df_{c}") + 1.0) / (n_all - sizes[c] + 2.0))
        coefs.append((inside - outside).alias(f"coef_{c}"))
    intercepts = {c: F.ln(sizes[c] / n_all) for c in classes}
    model = with_idf(seen.where((F.col("df") >= min_df) & (F.col("__df") > 0)), n_all)
    return model.select("term", "idf", *coefs), intercepts


def read_linear_model(spark: SparkSession, path: str):
    """An exported linear model: (term rows with idf and one coefficient per class, intercepts, classes).

    The JSON file has ``classes``, ``vocab`` (term to position), ``idf``, ``coef`` (a row per class, in order of
    the positions) and ``intercept``.
    """
    schema = ("classes array<string>, ngram_max int, vocab map<string,int>, idf array<double>, "
              "coef array<array<double>>, intercept array<double>")
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    head = raw.select("classes", "intercept").first()
    terms = raw.select("idf", "coef", F.explode("vocab").alias("term", "i"))
    coefs = [F.get(F.get("coef", F.lit(c)), F.col("i")).alias(f"coef_{name}") for c, name in enumerate(head.classes)]
    return terms.select("term", F.get("idf", F.col("i")).alias("idf"), *coefs), dict(zip(head.classes, map(F.lit, head.intercept))), head.classes


def linear_scores(weights: DataFrame, model: DataFrame, intercepts: dict, key: str, classes,
                  items: DataFrame) -> DataFrame:
    """Dot product per class plus intercept and the winning class.

    All classes are scored in one row, so the join does not multiply rows; an
    item without known terms keeps the intercepts.  Ties go to the first class.
    """
    hits = weights.join(model, "term").groupBy(key).agg(
        *[F.sum(F.col("weight") * F.col(f"coef_{c}")).alias(f"dot_{c}") for c in classes])
    return _best_class(items.join(hits, key, "left"), intercepts, classes)


def linear_scores_of_counts(counts: DataFrame, model: DataFrame, intercepts: dict, key: str, classes,
                            items: DataFrame) -> DataFrame:
    """``linear_scores`` of normalised tf * idf, for a model that has every term of the vocabulary and its idf.

    Length and dot products are added up together, so counts move once to their term and the products once to their item.
    """
    w = F.col("tf") * F.col("idf")
    found = counts.where(F.col(key).isNotNull()).select(key, "term", "tf").join(model, "term").select(
        key, (w * w).alias("__sq"), *[(w * F.col(f"coef_{c}")).alias(f"dot_{c}") for c in classes])
    sums = found.groupBy(key).agg(F.sqrt(F.sum("__sq")).alias("__norm"), *[F.sum(f"dot_{c}").alias(f"dot_{c}") for c in classes])
    hits = sums.select(key, *[(F.col(f"dot_{c}") / F.col("__norm")).alias(f"dot_{c}") for c in classes])
    return _best_class(items.join(hits, key, "left"), intercepts, classes)


def _best_class(rows: DataFrame, intercepts: dict, classes) -> DataFrame:
    scores = {c: F.coalesce(F.col(f"dot_{c}"), F.lit(0.0)) + intercepts[c] for c in classes}
    rows = rows.withColumns({f"score_{c}": s for c, s in scores.items()})
    rows = rows.drop(*[f"dot_{c}" for c in classes])
    best = F.greatest(*[F.col(f"score_{c}") for c in classes])
    pick = None
    for c in classes:
        hit = F.col(f"score_{c}") == best
        pick = F.when(hit, c) if pick is None else pick.when(hit, c)
    return rows.withColumn("y_pred", pick)


def nearest_example(queries: DataFrame, examples: DataFrame, q: str, e: str, k: int = 1,
                    floor: float = 1e-9) -> DataFrame:
    """Top-k examples by cosine, exact, without pairing through common terms.

    Both inputs are L2-normalised rows (key, term, weight).  First the examples met through each query's
    rarest terms are scored in full; the k-th of these cosines bounds the answer from below.  With b_t the
    largest weight of term t among the examples, q_t * b_t is the most t can add to any cosine, so terms whose summed bounds
    stay under that line cannot lift an example into the answer alone.  The commonest for their
    bound are skipped; the others find the remaining candidates, which are then scored in full.
    """
    met, seek = candidates(queries, examples, q, e, k)
    found = seek.join(examples.select(e, "term"), "term").select(q, e).distinct().join(met.select(q, e), [q, e], "left_anti")
    sims = met.unionByName(full_scores(found, queries, examples, q, e)).where(F.col("similarity") > floor)
    rank = F.row_number().over(Window.partitionBy(q).orderBy(F.desc(F.round("similarity", 9)), e))
    return sims.withColumn("rank", rank).where(F.col("rank") <= k)


def full_scores(pairs: DataFrame, queries: DataFrame, examples: DataFrame, q: str, e: str) -> DataFrame:
    """Cosine of given (query, example) pairs over all shared terms."""
    rows = pairs.join(queries, q).join(examples.withColumnRenamed("weight", "__ew"), [e, "term"])
    return rows.groupBy(q, e).agg(F.sum(F.col("weight") * F.col("__ew")).alias("similarity"))


def candidates(queries: DataFrame, examples: DataFrame, q: str, e: str, k: int):
    """(scored pairs met through rare terms, (query, term) rows that must still be looked up)."""
    per_term = examples.groupBy("term").agg(F.count("*").alias("__df"), F.max("weight").alias("__b"))
    bounds = queries.join(per_term, "term").withColumn("__ub", F.col("weight") * F.col("__b"))
    mine = Window.partitionBy(q)  # the terms of one query
    before = Window.unboundedPreceding
    rare = mine.orderBy("__df", "term").rowsBetween(before, -1)
    # a term adds its bound per example it costs: skip the cheapest bounds per cost first
    common = mine.orderBy(F.col("__ub") / F.col("__df"), "term").rowsBetween(before, 0)
    bounds = bounds.withColumns({
        "__seed": F.coalesce(F.sum("__df").over(rare), F.lit(0)) < 4 * k, "__spent": F.sum("__ub").over(common)})
    pairs = bounds.where("__seed").join(examples.select(e, "term"), "term").select(q, e).distinct()
    met = full_scores(pairs, queries, examples, q, e)
    kth = met.groupBy(q).agg(F.sort_array(F.collect_list("similarity"), asc=False).alias("__all"))  # a few times k each
    kth = kth.select(q, F.coalesce(F.get("__all", F.lit(k - 1)), F.lit(0.0)).alias("__low"))
    seek = bounds.where("NOT __seed").join(kth, q).where(F.col("__spent") >= F.col("__low") - 1e-8).select(q, "term")
    return met, seek


def class_centres(vectors: DataFrame, label: str, embedding: str, dim: int) -> DataFrame:
    """Mean vector per class as an array, from one partial aggregation."""
    parts = [F.avg(F.col(embedding)[i].cast("double")).alias(f"d{i}") for i in range(dim)]
    wide = vectors.groupBy(label).agg(*parts)
    return wide.select(label, F.array(*[f"d{i}" for i in range(dim)]).alias("centre"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def cosine_to_centres(vectors: DataFrame, centres: DataFrame, key: str, label: str, embedding: str) -> DataFrame:
    """Cosine of every vector to every class centre.

    The centres arrive as one array value (classes x dimensions numbers), so the
    vectors are scanned once and never shuffled.
    """
    # Each centre is scaled to length 1, so the vector's own norm completes the cosine.
    unit = centres.withColumn("__n", F.sqrt(dot(F.col("centre"), F.col("centre")))).select(
        F.struct(F.col(label).alias("centre_label"),
                 F.transform("centre", lambda x: x / F.col("__n")).alias("v")).alias("c"))
    packed = unit.agg(F.array_sort(F.collect_list("c"))).scalar()
    rows = vectors.withColumn("__norm", F.sqrt(dot(F.col(embedding), F.col(embedding))))
    sims = F.transform(F.col("__cs"), lambda c: F.struct(
        c["centre_label"].alias("centre_label"),
        (dot(F.col(embedding), c["v"]) / F.col("__norm")).alias("similarity")))
    return rows.withColumn("__cs", packed).withColumn("sims", sims).drop("__cs", "__norm")


def unit_box(df: DataFrame, columns, low=0.04, span=0.92, digits=4) -> DataFrame:
    """Scale coordinates to a box with a margin; the ranges come from one aggregate."""
    lohi = F.struct(*[x for c in columns for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))])
    r = df.agg(lohi).scalar()
    out = df.withColumn("__r", r)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"__r.{c}_lo"), F.col(f"__r.{c}_hi")
        width = F.greatest(hi - lo, F.lit(1e-9))
        scaled[c] = F.round(low + span * (F.col(c) - lo) / width, digits)
    return out.withColumns(scaled).drop("__r")


def competence_grid(df: DataFrame, x: str, y: str, correct: str, cells: int) -> DataFrame:
    """Share of right answers per grid cell of a unit-box map."""
    def cell(c):
        return F.least(F.floor(F.col(c) * cells), F.lit(cells - 1)).cast("int")
    return df.groupBy(cell(x).alias("cell_x"), cell(y).alias("cell_y")).agg(
        F.count("*").alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))

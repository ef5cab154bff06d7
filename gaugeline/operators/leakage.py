"""Test passages found in training text, and scores with and without them."""

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.functions.text import judge_tokens, ngrams
from gaugeline.sources.tables import stored


KEY = ["h1", "h2"]


def shingles(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Distinct n-word shingles per row, as a 128-bit key of two hashes.

    They are made distinct inside the row, so nothing is shuffled, and the fixed
    16 bytes replace about 50 bytes of words wherever they travel next.
    """
    tokens = df.select(key, judge_tokens(F.col(text)).alias("__t"))
    grams = tokens.select(key, F.explode(F.array_distinct(ngrams(F.col("__t"), n))).alias("__s"))
    return grams.select(key, F.xxhash64("__s").alias("h1"), F.xxhash64(F.lit(1), "__s").alias("h2"))


def item_shingles(tests: DataFrame, item: str, n: int) -> DataFrame:
    """Shingles of the test items, with the item's count and their rarity rank.

    They are written out, so that joins with the documents are planned with their
    true size: broadcast while below Spark's threshold, shuffled by hash beyond.
    """
    t = shingles(tests, item, "text", n)
    common = t.groupBy(*KEY).agg(F.count("*").alias("__items"))
    mine = Window.partitionBy(item)
    ranked = t.join(common, KEY).withColumns({
        "rarity": F.row_number().over(mine.orderBy("__items", *KEY)),
        "n_shingles": F.count("*").over(mine),
    })
    return stored(ranked.select(item, *KEY, "rarity", "n_shingles"), "shingles")


def _shares(hits: DataFrame, doc: str, item: str) -> DataFrame:
    counted = hits.groupBy(doc, item).agg(F.count("*").alias("matched"), F.max("n_shingles").alias("n_shingles"))
    return counted.withColumn("share", F.col("matched") / F.col("n_shingles"))


def contamination(docs: DataFrame, tests: DataFrame, doc: str, item: str, n: int = 8) -> DataFrame:
    """Share of an item's shingles that a document contains, for all meeting pairs.

    Documents without any test shingle produce no rows.
    """
    t = item_shingles(tests, item, n).select(item, *KEY, "n_shingles")
    return _shares(shingles(docs, doc, "text", n).join(t, KEY), doc, item)


def contaminated_pairs(docs: DataFrame, tests: DataFrame, doc: str, item: str, min_share: float, n: int = 8) -> DataFrame:
    """Pairs whose document holds at least ``min_share`` of the item's shingles.

    An item of s shingles of which k must occur is certain to meet the document
    in any s - k + 1 of them.  The ones that fewest items share are looked up, so
    boilerplate common to many items and documents never pairs them all; the
    candidates are then counted over all shingles.
    """
    t = item_shingles(tests, item, n)
    need = F.ceil(F.lit(min_share) * F.col("n_shingles"))
    probes = t.where(F.col("rarity") <= F.col("n_shingles") - need + 1).select(item, *KEY)
    met = shingles(docs, doc, "text", n).join(probes, KEY)
    candidates = stored(met.select(doc, item).distinct(), "candidates")
    # A short candidate list is broadcast in turn: all other documents are passed
    # over without being shuffled or shingled again.
    suspects = docs.join(candidates.select(doc).distinct(), doc, "left_semi")
    again = shingles(suspects, doc, "text", n).join(candidates, doc)
    hits = again.join(t.select(item, *KEY, "n_shingles"), [item, *KEY])
    return _shares(hits, doc, item).where(F.col("share") >= min_share)


def flag_contaminated(rows: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    bad = hits.select(key).distinct().withColumn("__hit", F.lit(True))
    out = rows.join(bad, key, "left")
    return out.withColumn("slice", F.when(F.col("__hit"), "contaminated").otherwise("clean")).drop("__hit")

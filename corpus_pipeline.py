"""The corpus pipeline: five stages over documents, each fed with all rows that its predecessor kept."""

from pyspark.sql import DataFrame, functions as F

from gaugeline.sources.tables import discard, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier doesn't reject (score of 0.5 or more), as they came.

    It is fitted on this stage's rows with a label.  Null, empty and very long texts have a score like all others; repeated and
    equal rows share theirs, so they go or stay together.  Columns outside COLUMNS are ignored; an empty table stays empty.
    """
    from gaugeline.llm import quality as q

    weights = q.fit(docs, table(spark, sf_dir, "labels"))
    return q.score(docs, weights, COLUMNS, "__score").where("__score >= 0.5").select(*COLUMNS)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates (similarity of 0.80 or more): that of the least doc_id, null last, then of the least hash of the row.

    Rows without words belong to no group and all stay.  Rows that share a doc_id, or have none, are judged by their texts.
    Of rows that are equal in every column one stays.  Columns outside COLUMNS are ignored; an empty table stays empty.
    """
    from gaugeline.llm.near_duplicates import grouped

    whole = [*[F.col(c).isNull() for c in COLUMNS], *COLUMNS]
    rows = docs.select(*COLUMNS).withColumn("__a", F.xxhash64(*whole)).withColumn("__b", F.xxhash64(F.lit(1), *whole))
    groups = grouped(rows, 80, keep=["__a", "__b"]).where("group IS NOT NULL").groupBy("group")
    first = groups.agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__a", "__b")).alias("r")).select("r.__a", "r.__b")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.where(worded).join(first, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"])
    return kept.unionByName(rows.where(~worded)).select(*COLUMNS)


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, as they came.

    Null and empty texts hold none and stay; long texts are read whole; repeated rows are each judged.  Columns outside COLUMNS
    are ignored; an empty table, or benchmark, drops nothing.
    """
    from gaugeline.llm.decontamination import find_contamination

    found = find_contamination(docs.withColumn("__text", F.col("text")), table(spark, sf_dir, "benchmark"), keep=["__text", *[c for c in COLUMNS if c != "text"]])
    return found.where("NOT contaminated").withColumnRenamed("__text", "text").select(*COLUMNS)


def mask_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with every secret replaced by its kind; n_chars follows the text where one was found.

    Null and empty texts stay as they are; long texts are read whole; repeated rows are each masked alike.  Columns outside COLUMNS
    are ignored; an empty table stays empty.
    """
    from gaugeline.llm.secrets import scan_secrets

    found = scan_secrets(docs.withColumn("__text", F.col("text")), keep=["__text", *[c for c in COLUMNS if c != "text"]])
    changed = F.col("masked").isNotNull()
    return (found.withColumn("n_chars", F.when(changed, F.length("masked").cast("long")).otherwise(F.col("n_chars")))
            .withColumn("text", F.coalesce("masked", "__text")).select(*COLUMNS))


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its place in the mix of sources, ``mixing.mix`` with its defaults: no row goes.

    A null source is one of its own; null and empty texts take no room; a long text reaches beyond its slot; of equal rows either may
    come first.  Columns outside COLUMNS are ignored; an empty table gives an empty mix.
    """
    from gaugeline.llm.mixing import mix

    return mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
]

#: The classifier and the schedule aren't SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard(before)  # a stage's rows are needed by the next one only
    return STAGES[-1][1](spark, docs, sf_dir)

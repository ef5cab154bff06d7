"""Cleaning and validating labels, model answers, scorecards and metrics.

Rejected rows are never dropped silently: each ingest returns a value that is
NULL for a rejected row, and ``split_valid`` gives both frames.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions.frames import pinned
from gaugeline.functions.text import strip
from gaugeline.operators.numbering import running_number

LABEL_LIST = "array<string>"


def labels_shape(raw: Column) -> Column:
    s = strip(raw)
    parsed = F.from_json(F.replace(s, F.lit("'"), F.lit('"')), F.lit(LABEL_LIST))
    return (
        F.when(raw.isNull(), "missing")
        .when(s.rlike(r"(?s)^\[.*\]$") & parsed.isNotNull(), "list")
        .when(F.contains(s, F.lit(";")), "delimited")
        .otherwise("scalar"))


def parse_labels(raw: Column) -> Column:
    """Label array from a stringified list, a ;-list or a single label."""
    s, shape = strip(raw), labels_shape(raw)
    parts = F.filter(F.transform(F.split(s, ";"), strip), lambda x: x != "")
    listed = F.from_json(F.replace(s, F.lit("'"), F.lit('"')), F.lit(LABEL_LIST))
    empty = F.array().cast(LABEL_LIST)
    return (
        F.when(shape == "missing", empty).when(shape == "list", listed)
        .when(shape == "delimited", parts).otherwise(F.array(s)))


def single_class(labels: Column, none: str = "∅") -> Column:
    return F.coalesce(F.get(labels, F.lit(0)), F.lit(none))


def parse_batch_answer(raw: Column) -> Column:
    """Array of answers from a model's raw reply; fences and prose are skipped.

    An answer that is itself a list counts by its first element.
    """
    body = F.regexp_extract(raw, r"(?s)(\[.*\])", 1)
    items = F.from_json(body, F.lit(LABEL_LIST))
    nested = lambda x: F.when(
        x.startswith("["), F.get(F.from_json(x, F.lit(LABEL_LIST)), F.lit(0))).otherwise(x)
    return F.transform(items, nested)


def align_batch(df: DataFrame, keys, items: str, raw: str, valid) -> DataFrame:
    """One row per batch item with its answer; NULL if absent or not allowed.

    ``items`` is the ordered array of item ids the batch was asked about, so the
    answers line up by position inside the batch and by id everywhere else.
    """
    answers = df.withColumn("__a", parse_batch_answer(F.col(raw)))
    rows = answers.select(*keys, "__a", F.posexplode(items).alias("__i", "item_id"))
    answer = F.get(F.col("__a"), F.col("__i"))
    allowed = F.when(answer.isin(list(valid)), answer)
    return rows.select(*keys, "item_id", allowed.alias("y_pred"))


def parse_scorecards(df: DataFrame, raw: str, out: str, dims=("accuracy", "completeness", "fluency")) -> DataFrame:
    """Scorecard struct from JSON inside prose; NULL unless all dimensions are in [1, 5].

    The schema asks for numbers, so a number written as text does not count.
    The reply is parsed once per row, into a column of its own.
    """
    schema = ", ".join(f"{d} double" for d in dims) + ", rationale string"
    body = F.regexp_extract(F.col(raw), r"(?s)\{.*\}", 0)
    rows = pinned(df, {"__card": F.from_json(body, F.lit(schema))})
    ok = F.lit(True)
    for d in dims:
        ok = ok & F.coalesce(F.col(f"__card.{d}").between(1.0, 5.0), F.lit(False))
    fields = [F.col(f"__card.{d}").alias(d) for d in dims]
    rationale = F.substring(F.coalesce(F.col("__card.rationale"), F.lit("")), 1, 300)
    card = F.when(ok, F.struct(*fields, rationale.alias("rationale")))
    return rows.withColumn(out, card).drop("__card", raw)


def reject_rate(df: DataFrame, by, value: str, *more) -> DataFrame:
    """Share of rows without a valid value, and any further aggregates, in one pass."""
    bad = F.col(value).isNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(bad).alias("rejected"),
        F.avg(bad.cast("double")).alias("reject_rate"), *more)


def split_valid(df: DataFrame, value: str):
    """(valid rows, quarantined rows)."""
    return df.where(F.col(value).isNotNull()), df.where(F.col(value).isNull())


def hard_checks(df: DataFrame, rules: dict) -> DataFrame:
    """Failures per programmatic rule in one pass; a rule is a boolean Column (True = fails)."""
    names = list(rules)
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(rules[r]).alias(r) for r in names])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in names])
    return wide.select("n", F.explode(pairs).alias("x")).select("x.rule", "n", "x.failed")


def contains_phrase(text: Column, phrases) -> Column:
    pattern = "|".join(phrases)
    return F.lower(text).rlike(rf"(?<![a-z0-9])(?:{pattern})(?![a-z0-9])")


def host_score(cpu_dev: Column, mem_dev: Column) -> Column:
    """Distance from the healthy state; NULL when an input is outside [0, 1]."""
    valid = cpu_dev.between(0.0, 1.0) & mem_dev.between(0.0, 1.0)
    return F.when(valid, F.sqrt(cpu_dev * cpu_dev + mem_dev * mem_dev))


def golden_diff(left: DataFrame, right: DataFrame, key, value: str, rel=1e-9, abs_=1e-12) -> DataFrame:
    """Keyed comparison of two result tables: strict and within tolerance."""
    keys = [key] if isinstance(key, str) else list(key)
    a = left.select(*keys, F.col(value).alias("a"))
    b = right.select(*keys, F.col(value).alias("b"))
    both = a.join(b, keys, "full_outer")
    bound = F.greatest(rel * F.greatest(F.abs("a"), F.abs("b")), F.lit(abs_))
    return both.withColumns({
        "strict": F.coalesce(F.col("a") == F.col("b"), F.lit(False)),
        "close": F.coalesce(F.abs(F.col("a") - F.col("b")) <= bound, F.lit(False)),
        "one_sided": F.col("a").isNull() != F.col("b").isNull(),
    })


def attach(pool: DataFrame, predictions: DataFrame, key, column: str) -> DataFrame:
    """Left join of stored predictions; an item without one is marked missing."""
    stored = predictions.select(key, column).withColumn("__hit", F.lit(True))
    out = pool.join(stored, key, "left")
    return out.withColumn("missing", F.col("__hit").isNull()).drop("__hit")


def alignment(left: DataFrame, right: DataFrame, key, value: str) -> DataFrame:
    """Mismatch counts of two stages that should describe the same items."""
    a = left.select(key, F.col(value).alias("__a"), F.lit(1).alias("__l"))
    b = right.select(key, F.col(value).alias("__b"), F.lit(1).alias("__r"))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count_if(F.col("__r").isNull()).alias("left_only"),
        F.count_if(F.col("__l").isNull()).alias("right_only"),
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()
                   & ~F.col("__a").eqNullSafe(F.col("__b"))).alias("value_differs"),
        F.count("*").alias("keys"))


def alignment_by_position(left: DataFrame, right: DataFrame, left_order, right_order, value: str) -> DataFrame:
    """Mismatch counts of two results that should match line by line, each in its own order.

    The order should end in a unique key.  Beyond the end of the shorter side the lines of the longer one count as left_only or right_only.
    """
    a = running_number(left.select(F.col(value).alias("__a"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(left_order)]), [f"__o{i}" for i in range(len(left_order))], "position")
    b = running_number(right.select(F.col(value).alias("__b"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(right_order)]), [f"__o{i}" for i in range(len(right_order))], "position")
    both = a.select("position", "__a", F.lit(1).alias("__l")).join(b.select("position", "__b", F.lit(1).alias("__r")), "position", "full_outer")
    paired = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    differs = paired & ~F.col("__a").eqNullSafe(F.col("__b"))
    return both.agg(F.count_if(F.col("__r").isNull()).alias("left_only"), F.count_if(F.col("__l").isNull()).alias("right_only"),
                    F.count_if(differs).alias("value_differs"), F.min(F.when(differs, F.col("position"))).alias("first_difference"),
                    F.count("*").alias("positions"))


def json_field(raw: Column, *keys: str) -> Column:
    """First non-empty of several fields of a JSON object; NULL on bad JSON."""
    parsed = F.from_json(raw, F.lit("map<string,string>"))
    return F.coalesce(*[F.nullif(F.try_element_at(parsed, F.lit(k)), F.lit("")) for k in keys])


def concat_parts(df: DataFrame, key: str, order: str, text: str, sep: str) -> DataFrame:
    """Join the parts of a document in order, with their number.

    One document is one output value, so its parts must meet in one row.
    """
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return df.groupBy(key).agg(parts.alias("p")).select(
        key, F.array_join(F.col(f"p.{text}"), sep).alias("text"), F.size("p").alias("n_parts"))


def tag_profile(df: DataFrame, tags: str):
    """Three tables: prevalence per tag, items per tag count, tag-pair counts.

    Pairs are formed inside the row from its few tags and counted map-side, so
    no rows meet through a common tag.
    """
    n = df.agg(F.count("*")).scalar()
    rows = df.select(F.array_sort(F.array_distinct(tags)).alias("t"))
    prevalence = rows.select(F.explode("t").alias("tag")).groupBy("tag").agg(
        F.count("*").alias("n")).withColumn("share", F.col("n") / n)
    sizes = rows.groupBy(F.size("t").alias("n_tags")).agg(F.count("*").alias("n"))
    pairs = F.flatten(F.transform("t", lambda a: F.transform(
        F.filter("t", lambda b: b > a), lambda b: F.struct(a.alias("tag_1"), b.alias("tag_2")))))
    together = rows.select(F.explode(pairs).alias("p")).groupBy("p.tag_1", "p.tag_2").agg(
        F.count("*").alias("n"))
    return prevalence, sizes, together

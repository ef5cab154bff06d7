"""Multi-class evaluation.

Every report starts from the confusion counts: one aggregation over the rows,
combined map-side, whose result has at most classes x (classes + 1) rows per
slice.  All metrics are then computed on that small frame.
"""

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.functions.frames import side_by_side
from gaugeline.functions.scores import f_measure, ratio

NO_ANSWER = "∅"


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def confusion(df: DataFrame, y_true="y_true", y_pred="y_pred", by=()) -> DataFrame:
    """Counts per (truth, prediction); a missing prediction is its own column."""
    pred = F.coalesce(F.col(y_pred).cast("string"), F.lit(NO_ANSWER)).alias("y_pred")
    truth = F.col(y_true).cast("string").alias("y_true")
    return df.groupBy(*by, truth, pred).agg(F.count("*").alias("n"))


def confusion_wide(counts: DataFrame, classes, prefix="pred_") -> DataFrame:
    columns = [(c, prefix + c) for c in classes] + [(NO_ANSWER, prefix + "none")]
    cells = [
        F.coalesce(F.sum(F.when(F.col("y_pred") == c, F.col("n"))), F.lit(0)).alias(name)
        for c, name in columns
    ]
    return counts.groupBy("y_true").agg(*cells)


def per_class(counts: DataFrame, by=(), classes=None) -> DataFrame:
    """tp / fp / fn / precision / recall / F1 / support per class.

    Each confusion cell adds to the support of its truth and to the guesses of
    its prediction, so one regrouping of the counts gives the whole table.
    ``classes`` fixes the label set; by default it is the classes of the truth.
    """
    right = F.col("y_true") == F.col("y_pred")
    sides = F.array(
        F.struct(F.col("y_true").alias("class"), F.when(right, F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("fp"), F.when(~right, F.col("n")).otherwise(0).alias("fn"),
                 F.lit(1).alias("in_set")),
        F.struct(F.col("y_pred").alias("class"), F.lit(0).cast("long").alias("tp"),
                 F.when(~right, F.col("n")).otherwise(0).alias("fp"), F.lit(0).cast("long").alias("fn"),
                 F.lit(0).alias("in_set")),
    )
    if classes is not None:
        empty = F.array(*[
            F.struct(F.lit(c).alias("class"), *[F.lit(0).cast("long").alias(x) for x in ("tp", "fp", "fn")],
                     F.lit(1).alias("in_set")) for c in classes])
        sides = F.concat(sides, empty)
    rows = counts.select(*by, F.explode(sides).alias("s")).select(*by, "s.*")
    if classes is not None:
        rows = rows.where(F.col("class").isin(list(classes)))
    table = (
        rows.groupBy(*by, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
             F.max("in_set").alias("in_set"))
        .where("in_set = 1").drop("in_set")
    )
    table = table.withColumns({
        "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "support": F.col("tp") + F.col("fn"),
    })
    return table.withColumn("f1", f_measure(F.col("precision"), F.col("recall")))


def summary(counts: DataFrame, by=(), classes=None) -> DataFrame:
    """n, correct, accuracy and macro averages.

    Macro precision and recall average the defined classes only (0 if none is);
    macro F1 averages all classes.
    """
    table = per_class(counts, by, classes)
    macro = [
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"),
    ]
    if classes is None:
        # Every truth is a class, so support and tp add up to n and correct.
        out = table.groupBy(*by).agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"), *macro)
    else:
        total = counts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(
            F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("correct"))
        per = table.groupBy(*by).agg(*macro)
        out = total.join(per, list(by)) if by else side_by_side(total, per)
    return out.withColumn("accuracy", F.col("correct") / F.col("n"))


def majority_class(df: DataFrame, label="y_true", by=()) -> DataFrame:
    """Most common class; a tie goes to the first class in alphabetical order."""
    counts = df.groupBy(*by, F.col(label).alias("class")).agg(F.count("*").alias("n"))
    best = F.min_by("class", F.struct(-F.col("n"), F.col("class")))
    return counts.groupBy(*by).agg(best.alias("top_class"), F.max("n").alias("top_n"))


def with_majority_prediction(df: DataFrame, train: DataFrame, label="y_true") -> DataFrame:
    top = majority_class(train, label).select("top_class").scalar()
    return df.withColumn("y_pred", top)


def compare_models(counts: DataFrame, models, by_model="model") -> DataFrame:
    """Per-class recall and F1 of several models side by side, by support."""
    table = per_class(counts, [by_model])
    cells = []
    for m in models:
        for metric in ("recall", "f1"):
            cells.append(F.max(F.when(F.col(by_model) == m, F.col(metric))).alias(f"{m}_{metric}"))
    wide = table.groupBy("class").agg(F.max("support").alias("support"), *cells)
    return wide.orderBy(F.desc("support"), "class")

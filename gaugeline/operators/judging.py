"""Judges of answers: programmatic, overlap-based, rubric, and QA rules."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions import text as tx
from gaugeline.functions.frames import unpivot, with_range

# How much a long answer impresses each rubric judge, and its cuts.
VERBOSITY_CAP, VERBOSITY_PER_TOKEN = 0.20, 0.012
STRICT_WEIGHT, STRICT_CUT = 0.25, 0.75
LENIENT_WEIGHT, LENIENT_CUT = 1.0, 0.45
SCALE_WEIGHT, SCALE_CUTS = 0.6, ((0.85, 5), (0.65, 4), (0.45, 3), (0.20, 2))


def exact_match(reply: Column, reference: Column) -> Column:
    return (tx.strip(reply) == tx.strip(reference)).cast("int")


def normalised_match(reply: Column, reference: Column) -> Column:
    return (tx.normalise(reply) == tx.normalise(reference)).cast("int")


def reply_pairs(turns: DataFrame) -> DataFrame:
    """Assistant turns beside the user turn just before them.

    An equi-join on (conversation, turn) spreads one huge conversation over all
    tasks; a lag window would put it into one.
    """
    ask = turns.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    say = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("reply"))
    return say.join(ask, ["conv_id", "turn"])


def token_overlap(pairs: DataFrame, keys, reply="reply", reference="reference") -> DataFrame:
    """Multiset token F1 per pair, with the token counts of both sides.

    Both token lists of a pair are exploded together, so the counts per token and
    the sums per pair share the partitioning of ``keys``; a pair without tokens
    keeps one empty row and scores 0.
    """
    def marked(tokens, mine, other):
        return F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(mine).alias("a"), F.lit(other).alias("b")))

    both = F.concat(marked(tx.judge_tokens(F.col(reply)), 1, 0),
                    marked(tx.judge_tokens(F.col(reference)), 0, 1))
    rows = pairs.select(*keys, F.explode_outer(both).alias("__x"))
    per_token = rows.groupBy(*keys, F.col("__x.t").alias("__t")).agg(F.sum("__x.a").alias("__a"), F.sum("__x.b").alias("__b"))
    sums = per_token.groupBy(*keys).agg(
        F.coalesce(F.sum(F.least("__a", "__b")), F.lit(0)).alias("overlap"),
        F.coalesce(F.sum("__a"), F.lit(0)).alias("n_reply"),
        F.coalesce(F.sum("__b"), F.lit(0)).alias("n_reference"),
    )
    prec = F.col("overlap") / F.nullif(F.col("n_reply"), F.lit(0))
    rec = F.col("overlap") / F.nullif(F.col("n_reference"), F.lit(0))
    f1 = F.when(F.col("overlap") > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return sums.withColumn("token_f1", f1)


def rubric_scores(overlap: Column, n_tokens: Column) -> dict:
    """Strict, lenient and 1-5 rubric verdicts from overlap and reply length."""
    bonus = F.least(F.lit(VERBOSITY_CAP), F.lit(VERBOSITY_PER_TOKEN) * n_tokens)
    graded = F.lit(1)
    for cut, points in reversed(SCALE_CUTS):
        graded = F.when(overlap + SCALE_WEIGHT * bonus >= cut, points).otherwise(graded)
    return {
        "strict": (overlap + STRICT_WEIGHT * bonus >= STRICT_CUT).cast("int"),
        "lenient": (overlap + LENIENT_WEIGHT * bonus >= LENIENT_CUT).cast("int"),
        "scale_1_5": graded,
    }


def qa_scores(answer: Column, reference: Column) -> dict:
    """Equality, containment and a graded 1-5 rule for short answers."""
    a, r = tx.normalise(answer), tx.normalise(reference)
    shares_word = F.arrays_overlap(
        F.filter(F.split(a, r"\s+"), lambda w: w != ""), F.filter(F.split(r, r"\s+"), lambda w: w != ""))
    return {
        "strict": (a == r).cast("int"),
        "lenient": F.contains(a, r).cast("int"),
        "scale_1_5": F.when(a == r, 5).when(F.contains(a, r), 4).when(shares_word, 3)
        .when(a.rlike(r"\p{L}"), 2).otherwise(1),
    }


@dataclass(frozen=True)
class Judge:
    name: str
    kind: str  # "binary", "scale_1_5" or "unit"
    score: Callable[[Column, Column], Column]


class JudgeRegistry:
    """Named judges; a judge may return any Column, a pandas UDF included."""

    def __init__(self):
        self._judges: dict[str, Judge] = {}

    def register(self, name, kind, score):
        if kind not in ("binary", "scale_1_5", "unit"):
            raise ValueError(f"unknown judge kind: {kind}")
        self._judges[name] = Judge(name, kind, score)
        return self

    def columns(self, reply="reply", reference="reference") -> dict:
        """Score column per judge; a value outside the judge's kind is NULL."""
        return {j.name: valid_score(j.score(F.col(reply), F.col(reference)), j.kind)
                for j in self._judges.values()}

    def run(self, df, keys, n_reruns=1, reply="reply", reference="reference") -> DataFrame:
        """Long table (keys, rerun, judge, score)."""
        rows = with_range(df, "rerun", n_reruns)
        return unpivot(rows, [*keys, "rerun"], self.columns(reply, reference), "judge", "score")


def valid_score(score: Column, kind: str) -> Column:
    score = score.cast("double")
    if kind == "binary":
        return F.when(score.isin(0.0, 1.0), score)
    low, high = (1.0, 5.0) if kind == "scale_1_5" else (0.0, 1.0)
    return F.when(score.between(low, high), score)


def parse_reply(reply: Column, kind: str) -> Column:
    """First number on the first line of a judge's reply, NULL if invalid."""
    first = F.regexp_extract(tx.strip(reply), r"^[^\r\n]*", 0)
    number = F.regexp_extract(first, r"-?[0-9]+(\.[0-9]+)?", 0)
    return valid_score(F.when(number != "", number.cast("double")), kind)


def sensitivity_grid(long: DataFrame, judge: str, slice_: str, slices, score: str) -> DataFrame:
    cells = [F.avg(F.when(F.col(slice_) == s, F.col(score))).alias(f"{s}_score") for s in slices]
    return long.groupBy(judge).agg(*cells)

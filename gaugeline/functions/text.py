"""Column builders for text: cleaning, tokens, n-grams."""

from pyspark.sql import Column, functions as F

# Patterns that decide what a token is.
JUDGE_TOKEN = r"[a-z0-9]+"
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"
PLACEHOLDER = r"\{\{.*?\}\}"
TRAILING_PUNCTUATION = ".,!?;:"


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` only drops blanks)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def normalise(text: Column) -> Column:
    """strip, drop trailing punctuation, lower, collapse white space, in that order.

    "Paris ." keeps the blank before the full stop, because stripping comes first.
    """
    bare = F.rtrim(strip(text), F.lit(TRAILING_PUNCTUATION))
    return F.regexp_replace(F.lower(bare), r"\s+", " ")


def judge_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(JUDGE_TOKEN), F.lit(0))


def masked_tokens(text: Column) -> Column:
    """Judge tokens with template placeholders blanked first."""
    masked = F.regexp_replace(F.lower(text), PLACEHOLDER, " ")
    return F.regexp_extract_all(masked, F.lit(JUDGE_TOKEN), F.lit(0))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def excerpt(text: Column, words: int) -> Column:
    """The first ``words`` words; the split stops there, so long texts stay cheap."""
    head = F.split(strip(text), r"\s+", words + 1)
    return F.array_join(F.slice(head, 1, words), " ")


def ngrams(tokens: Column, n: int) -> Column:
    """Word n-grams joined by one blank.

    ``tokens`` must be a plain column, or the lambda would re-tokenise per n-gram.
    Words are picked by index, because a slice would copy the whole array each time.
    """
    starts = F.sequence(F.lit(0), F.size(tokens) - F.lit(n))
    grams = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + j) for j in range(n)]))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def ngrams_upto(tokens: Column, n_max: int) -> Column:
    return F.concat(*[ngrams(tokens, n) for n in range(1, n_max + 1)])

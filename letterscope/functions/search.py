"""Analysed text and term tests."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterscope.functions.text import as_col, bind

# Fixed values -------------------------------------------------------------
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
]
WORD = r"([\p{L}\p{N}]+)"
# --------------------------------------------------------------------------


def analyze(text: Column | str) -> Column:
    """Lower-case words of the text in order, without stop words.  Null gives null."""
    words = F.regexp_extract_all(F.lower(as_col(text)), F.lit(WORD), F.lit(1))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(words, lambda w: ~F.array_contains(stop, w))


def _terms(query: str) -> list[str]:
    """The same analysis for a query string, once, on the caller's side."""
    import regex

    words = regex.findall(r"[\p{L}\p{N}]+", query.lower())
    return sorted({w for w in words if w not in STOP_WORDS})


def _whole_word(text: Column, term: str) -> Column:
    # A plain substring test settles most rows; the pattern confirms the rest.
    return F.contains(text, F.lit(term)) & text.rlike(
        rf"(?<![\p{{L}}\p{{N}}]){term}(?![\p{{L}}\p{{N}}])"
    )


def _combined(text: Column | str, query: str, join: Callable[[Column, Column], Column]) -> Column:
    terms = _terms(query)
    if not terms:
        return F.lit(False)
    lowered = F.lower(F.coalesce(as_col(text), F.lit("")))
    return bind(lowered, lambda t: reduce(join, [_whole_word(t, term) for term in terms]))


def matches_any(text: Column | str, query: str) -> Column:
    """At least one query term is a word of the text."""
    return _combined(text, query, lambda a, b: a | b)


def matches_all(text: Column | str, query: str) -> Column:
    """Every query term is a word of the text; a query of stop words only matches nothing."""
    return _combined(text, query, lambda a, b: a & b)


def token_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document and distinct term, with its count: ``key, token, occurrences``.

    Worth storing when many queries hit the same texts.  Each group is one
    term of one document, so no common word gathers in one task.
    """
    tokens = df.select(key, F.explode(analyze(text)).alias("token"))
    return tokens.groupBy(key, "token").agg(F.count("*").alias("occurrences"))

"""Cleaning of text cells and guarded conversions.  All native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Cells that stand for "no value", compared before any trimming.
NULL_WORDS = ["", "N/A", "NA", "NaN", "nan", "None", "null"]
DECIMAL_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
SIGNED_INTEGER = r"^[+-]?[0-9]+\z"
DIGITS = r"^[0-9]+\z"
# Seconds of 0001-01-01 and 10000-01-01, the range a timestamp can show.
FIRST_SECOND = -62135596800
END_SECOND = 253402300800
# --------------------------------------------------------------------------


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it many times in ``body``.

    Repeating a large expression instead makes the generated code outgrow the
    JVM's method limit.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _edge_may_go(text: Column) -> Column:
    """False if neither end can be white space or a quote: plain ASCII marks above ``'``.

    Trimming with a character set costs far more than looking at two
    characters, and nearly all cells need no trimming.
    """
    def suspect(char: Column) -> Column:
        code = F.ascii(char)
        return (code <= 39) | (code >= 127)

    return suspect(text) | suspect(F.right(text, F.lit(1)))


def strip(value: Column | str) -> Column:
    """Remove white space at both ends (Spark's plain ``trim`` removes blanks only)."""
    return F.btrim(as_col(value), F.lit(WHITESPACE))


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def strip_or_null(value: Column | str) -> Column:
    return empty_to_null(strip(value))


def clean_value(value: Column | str) -> Column:
    """Null words become null; then blanks, double quotes, single quotes, blanks go."""
    cell = as_col(value)
    blanks = F.lit(WHITESPACE)
    bare = F.btrim(F.btrim(F.btrim(cell, blanks), F.lit('"')), F.lit("'"))
    trimmed = F.when(_edge_may_go(cell), empty_to_null(F.btrim(bare, blanks))).otherwise(cell)
    return F.when(~cell.isin(NULL_WORDS), trimmed)


def _matched(text: Column, pattern: str, kind: str) -> Column:
    # Extracting instead of testing names the input once, which keeps nested
    # expressions small; no match extracts '' and '' casts to null.
    return F.regexp_extract(text, pattern, 0).try_cast(kind)


def safe_int(value: Column | str) -> Column:
    """Signed integer text to bigint, else null."""
    return _matched(strip(value), SIGNED_INTEGER, "bigint")


def digit_int(value: Column | str) -> Column:
    """Digits-only text to int, else null (``250-`` and ``-1`` give null)."""
    return _matched(as_col(value), DIGITS, "int")


def to_double(value: Column | str) -> Column:
    """Decimal text to double, else null.  Spark alone would also take ``1.5f``."""
    return _matched(strip(value), DECIMAL_NUMBER, "double")


def epoch_ts(seconds: Column | str) -> Column:
    """Epoch seconds (double) to a timestamp, to the nearest microsecond."""
    def stamp(value: Column) -> Column:
        inside = (value >= F.lit(float(FIRST_SECOND))) & (value < F.lit(float(END_SECOND)))
        return F.when(inside, F.timestamp_micros(F.rint(value * F.lit(1e6)).cast("bigint")))

    return bind(as_col(seconds), stamp)


def contains_any_case(value: Column | str, word: str) -> Column:
    """True if ``word`` (upper case) occurs in the value in any case; never null."""
    return F.coalesce(F.contains(F.upper(as_col(value)), F.lit(word)), F.lit(False))

"""E-mail addresses out of free text and SMTP parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col, strip

# Fixed value --------------------------------------------------------------
ADDRESS = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# --------------------------------------------------------------------------

# A match always starts where a run of local-part characters starts, so saying
# so changes no result and keeps the search linear on long runs.
_RUN_START = r"(?<![a-zA-Z0-9._%+-])"


def has_at(value: Column | str) -> Column:
    return F.contains(as_col(value), F.lit("@"))


def _if_address(value: Column) -> Column:
    # Names its input once: nested conditions would repeat whole expressions.
    return F.get(F.filter(F.array(value), has_at), F.lit(0))


def _after(text: Column, marker: str) -> Column:
    """The piece between the first and second marker (case-sensitive), if an address."""
    piece = F.get(F.split(text, marker, -1), F.lit(1))
    return F.when(F.contains(text, F.lit(marker)), _if_address(strip(F.translate(piece, "<>", ""))))


def extract_address(value: Column | str) -> Column:
    """First address in the text, else what follows ``FROM:``, else what follows ``TO:``."""
    text = as_col(value)
    direct = F.get(F.regexp_extract_all(text, F.lit(_RUN_START + "(" + ADDRESS + ")"), F.lit(1)), F.lit(0))
    return F.when(has_at(text), F.coalesce(direct, _after(text, "FROM:"), _after(text, "TO:")))


def parameter_address(value: Column | str) -> Column:
    """:func:`extract_address`, else the content of ``<...>`` if it has an ``@``."""
    text = as_col(value)
    inner = strip(F.substring(text, F.lit(2), F.length(text) - 2))
    bracketed = F.startswith(text, F.lit("<")) & F.endswith(text, F.lit(">"))
    return F.coalesce(extract_address(text), F.when(bracketed, _if_address(inner)))


def final_address(own: Column | str, parameter: Column | str) -> Column:
    """Own field's address, else the parameter's, else the raw own field if it has ``@``."""
    raw = as_col(own)
    return F.coalesce(extract_address(raw), parameter_address(parameter), F.when(has_at(raw), strip(raw)))

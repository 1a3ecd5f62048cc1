"""JSON texts with a fixed layout: sorted keys, ``", "`` and ``": "`` between, everything but printable ASCII escaped.

Two records have one text exactly if they are equal, so a digest of the text is
an identity.  All of it are expressions; texts are worked through in runs of
printable and other characters, not one character at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col

_SHORT = [("\\u0008", "\\b"), ("\\u0009", "\\t"), ("\\u000a", "\\n"), ("\\u000c", "\\f"), ("\\u000d", "\\r")]


def _escaped_run(run: Column) -> Column:
    printable = F.replace(F.replace(run, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    units = F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")
    for long, short in _SHORT:
        units = F.replace(units, F.lit(long), F.lit(short))
    return F.when(run.rlike("^[ -~]"), printable).otherwise(units)


def json_text(value: Column | str) -> Column:
    """A string in quotes, null for null."""
    runs = F.regexp_extract_all(as_col(value), F.lit("([ -~]+|[^ -~]+)"), F.lit(1))
    return F.concat(F.lit('"'), F.array_join(F.transform(runs, _escaped_run), ""), F.lit('"'))


def json_number(value: Column | str) -> Column:
    return as_col(value).cast("string")


def json_list(values: Column | str, show: Callable[[Column], Column]) -> Column:
    """A list, null for null; elements are shown by ``show``, null ones as ``null``."""
    shown = F.transform(as_col(values), lambda v: F.coalesce(show(v), F.lit("null")))
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))


def json_object(members: dict[str, Column], keep_nulls: bool = True) -> Column:
    """An object with the given members, already shown; null ones as ``null`` or left out."""
    shown = []
    for name in sorted(members):
        value = F.coalesce(members[name], F.lit("null")) if keep_nulls else members[name]
        shown.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}"))


def json_map(entries: Column | str) -> Column:
    """A map of strings, null for null."""
    ordered = F.array_sort(F.map_entries(as_col(entries)))
    pairs = F.transform(ordered, lambda e: F.concat(json_text(e["key"]), F.lit(": "), F.coalesce(json_text(e["value"]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))

"""Dates in mail headers: a lenient reader and the strict load check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col, bind, strip

# Fixed values -------------------------------------------------------------
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
DAYS = "mon|tue|wed|thu|fri|sat|sun"
# Zone names of RFC 2822 and their offsets as +-HHMM.
ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -400, "ADT": -300, "EST": -500, "EDT": -400, "CST": -600,
    "CDT": -500, "MST": -700, "MDT": -600, "PST": -800, "PDT": -700,
}
STRICT_MAIL_DATE = (
    r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), [0-9]{2} (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) "
    r"[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}\z"
)
EPOCH_MILLIS = r"^-?[0-9]{1,15}\z"
ISO_DATE = (
    r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2}(T[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?)?)?\z"
)
# --------------------------------------------------------------------------

_MONTH_OF = {name: i for i, full in enumerate(MONTHS, 1) for name in (full, full[:3])}
_CLOCK = r"^[0-9]{1,2}((:[0-9]{1,2}){1,2}|([.][0-9]{1,2}){1,2})\z"
_DAY_SECONDS = 86400


def _seconds(hhmm: Column) -> Column:
    size = F.abs(hhmm)
    return F.signum(hhmm).cast("int") * ((size / 100).cast("int") * 3600 + (size % 100) * 60)


def _full_year(year: Column) -> Column:
    """Two-digit years: 69-99 are 19xx, 00-68 are 20xx."""
    return F.when(year >= 100, year).when(year >= 69, year + 1900).otherwise(year + 2000)


def mail_date(value: Column | str) -> Column:
    """RFC 2822 date to ``struct<instant timestamp, offset_seconds int, iso string>``.

    Every word is told by its form, wherever it stands: a month's name, a clock
    with colons or dots, numbers (the day, then the year, then a zone without
    sign), and what is left is the zone.  A weekday before and a comment behind
    are unchecked.  A zone of ``-0000``, one that is neither a number nor known,
    or none leaves ``offset_seconds`` null and reads the clock as UTC.
    Unreadable text, a leap second and an offset of a day or more give null.
    """
    text = F.regexp_replace(strip(value), r"(\s*\([^()]*\))+\s*\z", "")
    text = F.regexp_replace(text, rf"(?i)^([a-z]+\s*,|({DAYS})\s)\s*", "")
    text = F.regexp_replace(text, r"^([0-9]+)-([A-Za-z]+)-([0-9]+)\b", "$1 $2 $3")
    text = F.regexp_replace(text, r"([:.][0-9]{1,2})([+-])", "$1 $2")
    words = F.split(strip(F.regexp_replace(text, r"([0-9]),(\s|\z)", "$1 ")), r"\s+")
    return bind(words, _read)


def _read(words: Column) -> Column:
    months = F.create_map(*[F.lit(x) for pair in _MONTH_OF.items() for x in pair])

    def at(found: Column, i: int) -> Column:
        return F.get(found, F.lit(i))

    named = F.filter(words, lambda w: months[F.lower(w)].isNotNull())
    clocks = F.filter(words, lambda w: w.rlike(_CLOCK))
    numbers = F.filter(words, lambda w: w.rlike(r"^[0-9]+\z"))
    others = F.filter(words, lambda w: months[F.lower(w)].isNull() & ~w.rlike(_CLOCK) & ~w.rlike(r"^[0-9]+\z"))
    clock = F.split(at(clocks, 0), "[:.]")
    second = F.coalesce(at(clock, 2).try_cast("int"), F.lit(0))
    made = F.try_make_timestamp_ntz(
        _full_year(at(numbers, 1).try_cast("int")), months[F.lower(at(named, 0))], at(numbers, 0).try_cast("int"),
        at(clock, 0).try_cast("int"), at(clock, 1).try_cast("int"), second.cast("decimal(16,6)"),
    ).cast("timestamp")
    zone = F.coalesce(at(others, 0), at(numbers, 2))
    names = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    numeric = F.when(zone.rlike(r"^[+-]?[0-9]+\z") & ~zone.rlike(r"^-0+\z"), zone.try_cast("int"))
    offset = bind(F.coalesce(numeric, names[F.upper(zone)]), _seconds)
    # A word of no known form before the date is not part of one.
    sound = (second < 60) & ~(at(words, 0) == F.coalesce(at(others, 0), F.lit(""))) & (F.size(words) <= 6)
    return bind(F.struct(made.alias("clock"), offset.alias("offset"), sound.alias("sound")), _show)


def _show(d: Column) -> Column:
    clock, offset = d["clock"], d["offset"]
    minutes = F.abs(offset / 60).cast("int")
    shown = F.concat(
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad((minutes / 60).cast("int").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((minutes % 60).cast("string"), 2, "0"),
    )
    shift = F.coalesce(offset, F.lit(0)).cast("bigint")
    parsed = F.struct(
        F.timestamp_micros(F.unix_micros(clock) - shift * 1000000).alias("instant"),
        offset.alias("offset_seconds"),
        F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce(shown, F.lit(""))).alias("iso"),
    )
    within = F.coalesce(F.abs(offset) < _DAY_SECONDS, F.lit(True))
    return F.when(clock.isNotNull() & d["sound"] & within, parsed)


def strict_date(value: Column | str) -> Column:
    """Timestamp of a date the load accepts, else null.

    Accepted: a mail date with two-digit day and numeric zone and no comment,
    epoch milliseconds, or an ISO date with optional time.
    """
    text = as_col(value)
    iso = F.regexp_replace(text, ",", ".")
    return F.coalesce(
        F.when(text.rlike(STRICT_MAIL_DATE), mail_date(text)["instant"]),
        F.when(
            text.rlike(EPOCH_MILLIS) & ~text.rlike("^[0-9]{4}\\z"),
            F.timestamp_millis(text.try_cast("bigint")),
        ),
        F.when(text.rlike(ISO_DATE), F.try_to_timestamp(iso)),
    )

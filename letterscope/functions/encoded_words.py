"""Header lines and encoded words as column expressions.

Questions about a header need no parsing of whole messages: the header region
is cut from the stored bytes, one header is unfolded, and its encoded words are
decoded, all in the JVM.  Charsets outside ``CHARSETS`` are left to the parser:
a text with such a word gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col

# Fixed values -------------------------------------------------------------
CODED = r"=\?[^?\s]+\?[bBqQ]\?[^?\s]*\?="
CHARSETS = ("utf-8", "utf8", "us-ascii", "ascii", "iso-8859-1", "latin-1", "iso-8859-15", "windows-1252")
# Where the two Western charsets differ from iso-8859-1; a byte without a character is a replacement mark.
LATIN_9 = dict(zip("¤¦¨´¸¼½¾", "€ŠšŽžŒœŸ", strict=True))
WINDOWS = {chr(b): bytes([b]).decode("windows-1252", "replace") for b in range(0x80, 0xA0)}
# --------------------------------------------------------------------------


def header(content: Column | str, name: str) -> Column:
    """Unfolded text of the first header ``name`` in a message's bytes; null without one, or without content."""
    text = F.make_valid_utf8(as_col(content).cast("string"))
    head = F.regexp_extract(text, r"(?s)\A(.*?)(?:\r?\n\r?\n|\z)", 1)
    line = F.regexp_extract_all(head, F.lit(rf"(?im)^{name}:[ \t]*([^\r\n]*(?:\r?\n[ \t][^\r\n]*)*)"), F.lit(1))
    return F.rtrim(F.regexp_replace(F.get(line, F.lit(0)), r"\r?\n", ""))


def _bytes(way: Column, payload: Column) -> Column:
    """Payload of one word: base64 with its padding made up, or quoted bytes.  Null if it is no base64."""
    bare = F.regexp_replace(payload, "=+$", "")
    padded = F.concat(bare, F.repeat(F.lit("="), F.pmod(-F.length(bare), F.lit(4))))
    pieces = F.regexp_extract_all(F.translate(payload, "_", " "), F.lit("=[0-9A-Fa-f]{2}|[^=]+|="), F.lit(0))
    quoted = F.transform(pieces, lambda p: F.when(p.rlike("^=.."), F.substring(p, 2, 2)).otherwise(F.hex(F.encode(p, "UTF-8"))))
    return F.when(F.lower(way) == "b", F.try_to_binary(padded, F.lit("base64"))).otherwise(F.unhex(F.array_join(quoted, "")))


def _text(charset: Column, data: Column) -> Column:
    """Bytes as text; bad bytes become replacement marks."""
    latin = F.decode(data, "ISO-8859-1")
    return (
        F.when(charset.isin("utf-8", "utf8"), F.make_valid_utf8(data.cast("string")))
        .when(charset.isin("us-ascii", "ascii"), F.regexp_replace(latin, "[\\x{80}-\\x{ff}]", "�"))
        .when(charset.isin("iso-8859-1", "latin-1"), latin)
        .when(charset == "iso-8859-15", F.translate(latin, "".join(LATIN_9), "".join(LATIN_9.values())))
        .when(charset == "windows-1252", F.translate(latin, "".join(WINDOWS), "".join(WINDOWS.values())))
    )


def decode_words(value: Column | str) -> Column:
    """Text with its encoded words decoded, white space between two of them left out.

    Words that are no base64 decode to nothing.  Null gives null, and so does a
    word in a charset outside ``CHARSETS``.
    """
    text = as_col(value)
    closed = F.regexp_replace(text, rf"({CODED})[ \t\r\n]+(?={CODED})", "$1")
    # Each token is one encoded word or a run without one.
    tokens = F.regexp_extract_all(closed, F.lit(rf"(?s){CODED}|(?:(?!{CODED}).)+"), F.lit(0))

    def decoded(token: Column) -> Column:
        # =?charset?way?payload?=, where a charset may carry a language behind an asterisk
        part = F.split(token, r"\?")
        charset = F.lower(F.substring_index(F.get(part, F.lit(1)), "*", 1))
        known = F.coalesce(_bytes(F.get(part, F.lit(2)), F.get(part, F.lit(3))), F.lit(b""))
        return F.when(token.rlike(rf"\A{CODED}\z"), _text(charset, known)).otherwise(token)

    words = F.transform(tokens, decoded)
    return F.when(~F.exists(words, lambda w: w.isNull()), F.array_join(words, ""))

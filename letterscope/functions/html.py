"""HTML in message bodies."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterscope.functions.text import as_col

# Fixed values -------------------------------------------------------------
TAG = r"<[^>]+>"
UNSEEN = ("script", "style")
# --------------------------------------------------------------------------


class _Text(HTMLParser):
    """Collects text nodes; comments, doctype, script and style are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.seen: list[str] = []
        self.hidden = ""

    def handle_starttag(self, tag, attrs):
        if tag in UNSEEN:
            self.hidden = tag

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = ""

    def handle_data(self, data):
        if not self.hidden:
            self.seen.append(data)


def text_of(html: str | None) -> str | None:
    if html is None:
        return None
    reader = _Text()
    reader.feed(html)
    reader.close()
    return "".join(reader.seen)


@F.arrow_udf(T.StringType())
def _html_to_text(pages: pa.Array) -> pa.Array:
    return pa.array([text_of(p) for p in pages.to_pylist()], pa.string())


def html_to_text(html: Column | str) -> Column:
    return _html_to_text(as_col(html))


def looks_like_html(text: Column | str) -> Column:
    """True if the text holds a tag; null and empty give false."""
    return F.coalesce(as_col(text).rlike(TAG), F.lit(False))


def resolve_body(body_text: Column | str, body_html: Column | str) -> Column:
    """Plain text of a message body.

    Text that is really HTML is converted; empty text is taken from the HTML
    body; anything else stays.  Rows that need no conversion hand a null to
    the Python side, so only the HTML that is needed leaves the JVM.
    """
    text, html = as_col(body_text), as_col(body_html)
    blank = F.coalesce(text, F.lit("")) == ""
    source = F.when(looks_like_html(text), text).when(blank & (F.coalesce(html, F.lit("")) != ""), html)
    return F.coalesce(html_to_text(source), text)

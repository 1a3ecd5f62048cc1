"""MIME messages to records, in two forms.

One Python step takes a message apart into headers and parts; everything that
tells the two forms apart (what is a body, what is an attachment, what joins,
what wins) is column expressions over those parts.

* ``parse_messages`` - record with address lists; several bodies are joined;
  anything that is not a plain body part is an attachment.
* ``parse_content`` - record with all headers as a map; the last body wins;
  only named parts are attachments.
"""

from __future__ import annotations

import base64
import hashlib
import mimetypes
from collections.abc import Iterator
from email import policy
from email.header import decode_header, make_header
from email.parser import BytesParser
from email.utils import collapse_rfc2231_value

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterscope.functions.canonical import json_list, json_map, json_number, json_object, json_text
from letterscope.functions.text import as_col, strip_or_null
from letterscope.schemas import ATTACHMENT, struct

_PART = (
    "struct<leaf: int, content_type: string, disposition: string, filename: string, raw_filename: string, "
    "param_name: string, extension: string, size: bigint, md5: string, sha256: string, "
    "text: string, utf8_text: string>"
)
TAKEN_APART = (
    "problem string, unreadable array<string>, multipart boolean, content_type string, subject string, raw_subject string, "
    f"headers array<struct<name: string, value: string>>, header_map map<string,string>, parts array<{_PART}>"
)
# Headers the first form shows; others may be unreadable without harm.
SHOWN = ("message-id", "date", "from", "to", "cc", "bcc", "subject")
# Fixed value: the base64 alphabet, padding and line end.
BASE64_TEXT = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=\n")
# How many messages a worker holds taken apart, and bytes of them; one message may be larger.
HELD_ROWS, HELD_BYTES = 64, 1 << 22


_HEADERS: dict[tuple[str, str], object] = {}


class RememberingPolicy(policy.EmailPolicy):
    """The default policy, without reading the same header text again and again.

    The parser asks for a part's content type a dozen times, and messages share
    many headers; a header object depends on its name and text alone.
    """

    def header_fetch_parse(self, name, value):
        key = (name, value)
        if key not in _HEADERS:
            if len(_HEADERS) >= 1024:
                _HEADERS.clear()
            _HEADERS[key] = super().header_fetch_parse(name, value)
        return _HEADERS[key]


def sound(value: object) -> str | None:
    """Text that can be encoded; stray surrogates become replacement marks."""
    return None if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def decode_words(value: str) -> str:
    """Encoded words decoded; text that does not decode stays as it is."""
    try:
        return str(make_header(decode_header(value))) if value else value
    except Exception:
        return value


def decode_subject(value: str) -> str:
    """Encoded words decoded chunk by chunk, only where ``=?`` occurs."""
    if "=?" not in value:
        return value
    try:
        return "".join(
            chunk.decode(charset or "utf-8") if isinstance(chunk, bytes) else chunk
            for chunk, charset in decode_header(value)
        )
    except Exception:
        return value


_EXTENSIONS: dict[str, str] = {}


def extension(kind: str) -> str:
    """File extension for a content type, from the standard table alone."""
    if kind not in _EXTENSIONS:
        _EXTENSIONS[kind] = mimetypes.MimeTypes(()).guess_extension(kind) or ".bin"
    return _EXTENSIONS[kind]


def decode_charset(data: bytes, charset: str | None) -> str:
    try:
        return data.decode(charset or "utf-8", "replace")
    except (LookupError, ValueError):
        return data.decode("utf-8", "replace")


def second_base64(text: str) -> str:
    """Decode text that itself looks like base64 (short plain words do, too)."""
    if not text or len(text) % 4 or not set(text.strip()) <= BASE64_TEXT:
        return text
    try:
        return base64.b64decode(text).decode("utf-8", "ignore")
    except ValueError:
        return text


def _part(part, leaf: int | None, body_candidate: bool, again: bool) -> dict:
    kind = part.get_content_type()
    filename = part.get_filename()
    param = part.get_param("name", header="Content-Type")
    row = {
        "leaf": leaf, "content_type": sound(kind), "disposition": part.get_content_disposition(),
        "raw_filename": sound(filename), "filename": sound(decode_words(filename)) if filename else None,
        "param_name": sound(decode_words(collapse_rfc2231_value(param))) if param else None,
        "extension": extension(kind),
    }
    if leaf is None:
        return row
    data = part.get_payload(decode=True) or b""
    row["size"] = len(data)
    if data:
        row["md5"] = hashlib.md5(data).hexdigest()
        row["sha256"] = hashlib.sha256(data).hexdigest()
    if body_candidate or kind in ("text/plain", "text/html"):
        row["text"] = sound(decode_charset(data, part.get_content_charset()))
        if data:
            text = data.decode("utf-8", "ignore")
            row["utf8_text"] = second_base64(text) if again else text
    return row


def read_headers(message) -> tuple[list[tuple[str, str]], list[str]]:
    """Every header's name and text, and the lower-case names of those that do not parse.

    A header that does not parse keeps its raw text, unfolded.
    """
    headers, unreadable = [], []
    for name, raw in message.raw_items():
        try:
            value = message.policy.header_fetch_parse(name, raw)
        except Exception:
            unreadable.append(sound(name.lower()))
            value = " ".join(str(raw).split())
        headers.append((sound(name), sound(value)))
    return headers, unreadable


def take_apart(content: bytes, again: bool) -> dict:
    message = BytesParser(policy=RememberingPolicy()).parsebytes(content)
    headers, unreadable = read_headers(message)
    multipart = message.is_multipart()
    parts, leaves = [], 0
    for part in message.walk():
        container = part.is_multipart()
        leaves += not container
        parts.append(_part(part, None if container else leaves, not multipart, again))
    subject = next((v for k, v in headers if k.lower() == "subject"), "")
    return {
        "unreadable": unreadable, "multipart": multipart, "content_type": message.get_content_type(),
        "subject": sound(decode_words(subject)), "raw_subject": sound(decode_subject(subject)),
        "headers": [{"name": k, "value": v} for k, v in headers], "header_map": list(dict(headers).items()),
        "parts": parts,
    }


def _arrow_type() -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(struct(TAKEN_APART))


def _taken(content: bytes | None, again: bool) -> dict:
    if content is None:
        return {"problem": "no content"}
    try:
        return take_apart(content, again)
    except Exception as error:
        return {"problem": sound(f"{type(error).__name__}: {error}")}


def taken_apart(contents: Iterator[pa.Array], again: bool, returned: pa.DataType) -> Iterator[pa.Array]:
    """Batches of messages taken apart, returned in small ones.

    Messages grow several times over as Python objects, so what a worker holds
    of them must not depend on how many rows the session puts in a batch.
    """
    rows, size = [], 0
    for batch in contents:
        for item in batch:
            content = item.as_py()
            rows.append(_taken(content, again))
            size += len(content or b"")
            if len(rows) >= HELD_ROWS or size >= HELD_BYTES:
                yield pa.array(rows, returned)
                rows, size = [], 0
    if rows:
        yield pa.array(rows, returned)


def _taker(again: bool):
    returned = _arrow_type()

    def run(contents: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return taken_apart(contents, again, returned)

    # Marked nondeterministic so that a filter on the result does not make the
    # optimizer run the parser twice.
    return F.arrow_udf(run, returnType=struct(TAKEN_APART)).asNondeterministic()


def with_parts(messages: DataFrame, base64_pass: bool = False) -> DataFrame:
    """Replace ``content`` by ``mime``, the message taken apart."""
    others = [c for c in messages.columns if c != "content"]
    return messages.select(*others, _taker(base64_pass)("content").alias("mime"))


def _problem(unreadable: Column) -> Column:
    """Why a message counts as failed: it could not be taken apart, or one of ``unreadable`` headers is needed."""
    names = F.concat(F.lit("unreadable header: "), F.array_join(F.sort_array(F.array_distinct(unreadable)), ", "))
    return F.coalesce("mime.problem", F.when(F.size(unreadable) > 0, names))


def _values(name: str) -> Column:
    found = F.filter("mime.headers", lambda h: F.lower(h["name"]) == name.lower())
    return F.transform(found, lambda h: h["value"])


def _first(name: str) -> Column:
    return F.get(_values(name), F.lit(0))


def _is_text(part: Column) -> Column:
    return part["content_type"].isin("text/plain", "text/html")


def _given(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def _plain_body(part: Column) -> Column:
    """A body part of the first form: unnamed text without attachment or inline mark."""
    marked = F.coalesce(part["disposition"].isin("attachment", "inline"), F.lit(False))
    return _is_text(part) & ~marked & ~_given(part["filename"]) & ~_given(part["param_name"])


def parse_messages(messages: DataFrame) -> DataFrame:
    """First form.  Keeps the key columns, adds the message record and ``parse_error``.

    A message fails if it has no content or cannot be taken apart, or if a header
    shown here does not parse; its other fields are given as far as they were read.
    """
    keys = [c for c in messages.columns if c != "content"]
    df = with_parts(messages)
    leaves = F.filter("mime.parts", lambda p: p["leaf"].isNotNull())

    def body(kind: str) -> Column:
        chosen = F.filter(leaves, lambda p: _plain_body(p) & (p["content_type"] == kind))
        return strip_or_null(F.array_join(F.transform(chosen, lambda p: p["text"]), ""))

    def attachment(p: Column) -> Column:
        fallback = F.concat(F.lit("part-"), p["leaf"].cast("string"), p["extension"])
        name = F.coalesce(
            F.nullif(p["filename"], F.lit("")), F.nullif(p["param_name"], F.lit("")), fallback
        )
        return F.struct(
            name.alias("filename"), p["content_type"].alias("content_type"), p["size"].alias("size"),
            p["disposition"].alias("content_disposition"), p["md5"].alias("md5"), p["sha256"].alias("sha256"),
        )

    multipart = F.col("mime.multipart")
    only = strip_or_null(F.get("mime.parts", F.lit(0))["text"])
    attached = F.transform(F.filter(leaves, lambda p: ~_plain_body(p)), attachment)
    return df.select(
        *keys,
        _problem(F.array_intersect("mime.unreadable", F.array(*[F.lit(h) for h in SHOWN]))).alias("parse_error"),
        _first("Message-ID").alias("message_id"),
        _first("Date").alias("date"),
        _values("From").alias("from"), _values("To").alias("to"),
        _values("Cc").alias("cc"), _values("Bcc").alias("bcc"),
        F.col("mime.subject").alias("subject"),
        F.when(multipart, body("text/plain")).otherwise(only).alias("body_text"),
        F.when(multipart, body("text/html")).alias("body_html"),
        F.when(multipart, attached).when(~multipart, F.array()).cast(f"array<{ATTACHMENT}>").alias("attachments"),
    )


def parse_content(messages: DataFrame, base64_pass: bool = False) -> DataFrame:
    """Second form.  Needs ``file_id, filename, file_size`` beside the content.

    A named attached message becomes an attachment of unknown size.  This form
    shows all headers, so one that does not parse fails the message.
    """
    df = with_parts(messages, base64_pass)
    multipart = F.col("mime.multipart")
    not_attached = F.filter(
        "mime.parts",
        lambda p: _is_text(p) & (F.coalesce(p["disposition"], F.lit("")) != "attachment"),
    )

    def last(kind: str) -> Column:
        texts = F.transform(
            F.filter(not_attached, lambda p: (p["content_type"] == kind) & p["utf8_text"].isNotNull()),
            lambda p: p["utf8_text"],
        )
        return F.try_element_at(texts, F.lit(-1))

    raw_text = F.when(multipart, last("text/plain")).otherwise(F.get("mime.parts", F.lit(0))["utf8_text"])
    raw_html = F.when(multipart, last("text/html"))
    named = F.filter(
        "mime.parts",
        lambda p: _given(p["raw_filename"])
        & ~(_is_text(p) & (F.coalesce(p["disposition"], F.lit("")) != "attachment")),
    )
    attached = F.transform(
        named,
        lambda p: F.struct(
            p["raw_filename"].alias("filename"), p["content_type"].alias("content_type"),
            p["size"].alias("size"), p["md5"].alias("md5"), p["sha256"].alias("sha256"),
        ),
    )

    def text(name: str) -> Column:
        return F.coalesce(_first(name), F.lit(""))

    metadata = F.struct(
        text("Message-ID").alias("message_id"), text("Date").alias("date"), text("From").alias("from"),
        text("To").alias("to"), text("Cc").alias("cc"), text("Bcc").alias("bcc"),
        F.col("mime.raw_subject").alias("subject"), F.col("mime.content_type").alias("content_type"),
        text("Content-Transfer-Encoding").alias("content_transfer_encoding"),
        text("MIME-Version").alias("mime_version"), _values("Received").alias("received"),
    )
    problem = _problem(F.col("mime.unreadable"))
    parsed = problem.isNull()
    empty = F.array().cast("array<struct<filename:string,content_type:string,size:bigint,md5:string,sha256:string>>")
    others = [c for c in messages.columns if c not in ("content", "file_id", "filename", "file_size")]
    return df.select(
        *others, "file_id", "filename", "file_size",
        problem.alias("parse_error"),
        F.when(parsed, F.col("mime.header_map")).alias("headers"),
        F.when(parsed, F.struct(raw_text.alias("text"), raw_html.alias("html"))).alias("raw_body"),
        F.when(parsed, metadata).alias("metadata"),
        F.when(parsed, F.when(multipart, attached).otherwise(empty)).alias("attachments"),
    ).withColumn("body", tidy_body("raw_body"))


def tidy_body(raw: Column | str) -> Column:
    """Empty members become null; a body with none left is ``{text: ''}``."""
    body = as_col(raw)
    text, html = F.nullif(body["text"], F.lit("")), F.nullif(body["html"], F.lit(""))
    kept = F.when(text.isNull() & html.isNull(), F.lit("")).otherwise(text)
    return F.when(body.isNotNull(), F.struct(kept.alias("text"), html.alias("html")))


def _present(fields: dict) -> dict:
    return {k: v for k, v in fields.items() if v is not None}


@F.arrow_udf(T.IntegerType())
def _printed_length(bodies: pa.Array) -> pa.Array:
    return pa.array([None if b is None else len(str(_present(b))) for b in bodies.to_pylist()], pa.int32())


def record_text() -> Column:
    """JSON text of a second-form record before body clean-up; absent members of body and attachments are left out."""
    texts = ("message_id", "date", "from", "to", "cc", "bcc", "subject", "content_type", "content_transfer_encoding", "mime_version")
    metadata = {name: json_text(F.col("metadata")[name]) for name in texts}
    metadata["received"] = json_list(F.col("metadata")["received"], json_text)

    def attachment(a: Column) -> Column:
        shown = {name: json_text(a[name]) for name in ("filename", "content_type", "md5", "sha256")}
        return json_object(shown | {"size": json_number(a["size"])}, keep_nulls=False)

    empty_map = F.create_map().cast("map<string,string>")
    return json_object({
        "file_id": json_number("file_id"), "filename": json_text("filename"), "file_size": json_number("file_size"),
        "headers": json_map(F.coalesce("headers", empty_map)),
        "body": json_object({name: json_text(F.col("raw_body")[name]) for name in ("text", "html")}, keep_nulls=False),
        "attachments": json_list(F.coalesce("attachments", F.array()), attachment),
        "metadata": json_object(metadata),
    })


def email_hash() -> Column:
    """Identity of a second-form record: MD5 of its JSON text, file id and name included; null if it did not parse."""
    return F.when(F.col("parse_error").isNull(), F.md5(F.encode(record_text(), "UTF-8")))


def printed_body_length(body: Column | str = "body") -> Column:
    """Length of the body shown as a printed dict, the value older tables hold."""
    return _printed_length(as_col(body))


def enrich(content: DataFrame, parsed_at: Column | None = None) -> DataFrame:
    """Attachment flag and count, the length of the body's text and HTML, and the time (now, unless given)."""
    size = F.coalesce(F.size("attachments"), F.lit(0))
    length = F.coalesce(F.length("body.text"), F.lit(0)) + F.coalesce(F.length("body.html"), F.lit(0))
    return content.select(
        "*", (size > 0).alias("has_attachments"), size.alias("attachment_count"),
        length.alias("body_length"), (F.current_timestamp() if parsed_at is None else parsed_at).alias("parsed_at"),
    )


def preview(value: Column | str, width: int = 50) -> Column:
    return F.left(as_col(value), F.lit(width))



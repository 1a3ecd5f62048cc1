import hashlib
import json

import pytest
from pyspark.sql import functions as F

from letterscope.operators import mime

HEAD = "From: a@x.org\r\nTo: b@x.org\r\n"


def multipart(*parts, kind="mixed"):
    inner = "".join(f"--B\r\n{p}\r\n" for p in parts)
    return f'{HEAD}Content-Type: multipart/{kind}; boundary="B"\r\n\r\n{inner}--B--\r\n'


MAILS = {
    "text": HEAD + "Subject: =?utf-8?q?caf=C3=A9?=\r\nMessage-ID: <1@x>\r\n\r\n  hello \r\n",
    "html": HEAD + "Content-Type: text/html\r\n\r\n<p>x</p>",
    "two": multipart("Content-Type: text/plain\r\n\r\none", "Content-Type: text/plain\r\n\r\ntwo"),
    "named inline": multipart("Content-Disposition: inline; filename=n.txt\r\n\r\nnote"),
    "image": multipart("\r\nbody", "Content-Type: image/png\r\nContent-Transfer-Encoding: base64\r\n\r\nAAAA"),
    "name param": multipart("Content-Type: text/plain; name=p.txt\r\n\r\ntext", "Content-Type: application/pdf; name=q.pdf\r\n\r\nP"),
    "coded name": multipart("Content-Type: application/x\r\nContent-Disposition: attachment; filename=\"=?utf-8?q?=C3=A9.bin?=\"\r\n\r\nP"),
    "empty": multipart("Content-Type: application/x\r\nContent-Disposition: attachment; filename=e\r\n\r\n"),
    "rfc822": multipart("\r\nouter", "Content-Type: message/rfc822\r\nContent-Disposition: attachment; filename=in.eml\r\n\r\n"
                        "Subject: in\r\n\r\ninner"),
    "unknown charset": HEAD + "Content-Type: text/plain; charset=x-none\r\nContent-Transfer-Encoding: 8bit\r\n\r\ncafé",
    "bare": "X-Other: 1\r\n\r\ntest",
    "repeated": HEAD + "Received: one\r\nReceived: two\r\nCc: c\r\nCc: d\r\n\r\nx",
}


@pytest.fixture(scope="module")
def mails(spark):
    rows = [(n, n + ".eml", len(t.encode()), bytearray(t.encode())) for n, t in MAILS.items()]
    latin = (HEAD + "Content-Type: text/plain; charset=latin-1\r\nContent-Transfer-Encoding: 8bit\r\n\r\n").encode() + b"caf\xe9"
    rows.append(("latin", "latin.eml", len(latin), bytearray(latin)))
    return spark.createDataFrame(rows, "name string, filename string, file_size bigint, content binary")


@pytest.fixture(scope="module")
def first(mails):
    return {r["name"]: r for r in mime.parse_messages(mails.select("name", "content")).collect()}


@pytest.fixture(scope="module")
def second(mails):
    parsed = mime.parse_content(mails.withColumn("file_id", F.lit(7).cast("bigint")))
    rows = parsed.withColumn("h", mime.email_hash()).withColumn("printed", mime.printed_body_length()).collect()
    return {r["name"]: r for r in rows}


def test_nothing_fails(first, second):
    assert [r["parse_error"] for r in [*first.values(), *second.values()] if r["parse_error"]] == []


def test_first_form_bodies(first):
    assert (first["text"]["subject"], first["text"]["body_text"], first["text"]["body_html"]) == ("café", "hello", None)
    assert first["html"]["body_text"] == "<p>x</p>"
    assert first["two"]["body_text"] == "onetwo"
    assert first["latin"]["body_text"] == "café"
    assert first["unknown charset"]["body_text"] == "café"
    assert first["bare"]["body_text"] == "test"


def test_first_form_absent_values(first):
    r = first["bare"]
    assert (r["subject"], r["to"], r["message_id"], r["date"], r["attachments"]) == ("", [], None, None, [])
    assert first["repeated"]["cc"] == ["c", "d"]


def test_first_form_attachments(first):
    def names(n):
        return [a["filename"] for a in first[n]["attachments"]]

    assert names("named inline") == ["n.txt"] and first["named inline"]["body_text"] is None
    assert names("image") == ["part-2.png"]
    assert names("name param") == ["p.txt", "q.pdf"]
    assert names("coded name") == ["é.bin"]
    empty = first["empty"]["attachments"][0]
    assert (empty["size"], empty["md5"], empty["sha256"]) == (0, None, None)
    image = first["image"]["attachments"][0]
    assert (image["size"], image["sha256"]) == (3, hashlib.sha256(b"\0\0\0").hexdigest())
    assert first["rfc822"]["body_text"] == "outerinner" and names("rfc822") == []


def test_second_form(second):
    assert second["two"]["body"]["text"] == "two"
    assert second["named inline"]["body"]["text"] == "note" and second["named inline"]["attachments"] == []
    assert second["image"]["attachments"] == []
    assert [a["filename"] for a in second["name param"]["attachments"]] == ["q.pdf"]
    assert second["latin"]["body"]["text"] == "caf"
    assert second["rfc822"]["body"]["text"] == "inner"
    assert [(a["filename"], a["size"]) for a in second["rfc822"]["attachments"]] == [("in.eml", None)]
    assert second["bare"]["metadata"]["subject"] == "" and second["bare"]["metadata"]["to"] == ""
    repeated = second["repeated"]
    assert repeated["headers"]["Received"] == "two" and repeated["metadata"]["received"] == ["one", "two"]
    assert repeated["metadata"]["cc"] == "c"
    assert second["empty"]["body"].asDict() == {"text": "", "html": None}


def test_email_hash_is_md5_of_the_record(second):
    r = second["coded name"]
    record = {
        "file_id": 7, "filename": r["filename"], "file_size": r["file_size"], "headers": r["headers"], "body": {},
        "attachments": [{k: v for k, v in a.asDict().items() if v is not None} for a in r["attachments"]],
        "metadata": r["metadata"].asDict(),
    }
    assert r["h"] == hashlib.md5(json.dumps(record, sort_keys=True).encode()).hexdigest()
    assert len({x["h"] for x in second.values()}) == len(second)
    assert second["two"]["printed"] == len("{'text': 'two'}")


def test_base64_pass_is_off_unless_asked(mails, second):
    assert second["bare"]["body"]["text"] == "test"
    parsed = mime.parse_content(mails.filter("name = 'bare'").withColumn("file_id", F.lit(1)), base64_pass=True)
    assert parsed.first()["body"]["text"] == "-"


def test_unreadable_message_is_reported(spark):
    broken = b"From: a\r\nContent-Type: multipart/mixed; boundary=\"B\"\r\nDate: x\r\n\r\n\xff\xfe"
    df = spark.createDataFrame([(bytearray(broken),), (None,)], "content binary")
    assert mime.parse_messages(df).count() == 2
    assert [r["parse_error"] for r in mime.parse_messages(df.filter("content is null")).collect()] == ["no content"]


def test_unreadable_headers_fail_only_the_forms_that_show_them(spark):
    tail = "Subject: kept\r\n\r\nhello"
    mails = {"reply": f"{HEAD}Reply-To: <a@[b\r\n{tail}", "cc": f"{HEAD}Cc: <a@[b\r\n{tail}", "good": HEAD + tail}
    df = spark.createDataFrame(
        [(n, n, len(t), 1, bytearray(t.encode())) for n, t in mails.items()],
        "name string, filename string, file_size bigint, file_id bigint, content binary")
    first = {r["name"]: r for r in mime.parse_messages(df).collect()}
    second = {r["name"]: r for r in mime.parse_content(df).collect()}
    assert {n: r["parse_error"] for n, r in first.items()} == {
        "reply": None, "cc": "unreadable header: cc", "good": None}
    assert (first["reply"]["subject"], first["reply"]["body_text"]) == ("kept", "hello")
    assert {n: r["parse_error"] for n, r in second.items()} == {
        "reply": "unreadable header: reply-to", "cc": "unreadable header: cc", "good": None}
    assert second["reply"]["headers"] is None and second["good"]["headers"]["Subject"] == "kept"


def test_messages_are_parsed_once(mails):
    parsed = mime.parse_messages(mails.select("name", "content")).filter("parse_error is null and subject <> ''")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_messages_are_held_in_small_batches(spark):
    """One batch of many or of large messages comes back in several; all rows, in order."""
    kind = mime._arrow_type()
    many = [None if i == 7 else f"{HEAD}Subject: s{i}\r\n\r\nx".encode() for i in range(1000)]
    batches = list(mime.taken_apart(iter([mime.pa.array(many[:900]), mime.pa.array(many[900:])]), False, kind))
    assert max(map(len, batches)) <= mime.HELD_ROWS
    subjects = [r["subject"] for b in batches for r in b.to_pylist()]
    assert subjects == [None if i == 7 else f"s{i}" for i in range(1000)]
    large = [HEAD.encode() + b"\r\n" + b"x" * mime.HELD_BYTES] * 3
    assert [len(b) for b in mime.taken_apart(iter([mime.pa.array(large)]), False, kind)] == [1, 1, 1]
    assert list(mime.taken_apart(iter([]), False, kind)) == []
    df = spark.range(0, 500, 1, 1).select("id", F.encode(F.concat(F.lit("Subject: s"), F.col("id"), F.lit("\r\n\r\nx")), "UTF-8").alias("content"))
    assert {r["id"]: r["subject"] for r in mime.parse_messages(df).collect()} == {i: f"s{i}" for i in range(500)}

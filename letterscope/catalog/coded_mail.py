"""Queries over mail in other charsets, with encoded headers, and mail that fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterscope.catalog.adapters import table
from letterscope.functions.encoded_words import decode_words, header
from letterscope.operators import mime, reports
from letterscope.sources import documents as sources
from letterscope.staging import on_all_cores, single_files

QUERIES = {}
ORACLE = {}
_CRLF = "\r\n"


def query(name: str, sql: str):
    def keep(function):
        QUERIES[name] = function
        ORACLE[name] = sql
        return function

    return keep


def _word(text: Column, charset: str, way: str) -> Column:
    data = F.encode(text, "UTF-8" if charset == "utf-8" else "ISO-8859-1")
    inner = F.translate(F.base64(data), "\r\n", "") if way == "B" else F.regexp_replace(F.hex(data), "(..)", "=$1")
    return F.concat(F.lit(f"=?{charset}?{way}?"), inner, F.lit("?="))


def _mail(head: Column, body: Column | str) -> Column:
    return F.encode(F.concat(F.lit("From: a@example.com" + _CRLF), head, F.lit(_CRLF + _CRLF), body), "UTF-8")


def coded_headers_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for each document; its subject and file name are coded in one of six ways by ``doc_id % 6``.

    0: base64, 1: quoted, 2: quoted iso-8859-1, 3: two folded words that belong
    together, 4: a word between plain ones, 5: plain.
    """
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("Prüfung "), F.col("doc_id").cast("string"), F.lit(" für "), F.col("source"))
    k = F.col("doc_id") % 6
    coded = (
        F.when(k == 0, _word(F.concat(name, F.lit(" – ✓")), "utf-8", "B")).when(k == 1, _word(name, "utf-8", "Q"))
        .when(k == 2, _word(name, "iso-8859-1", "Q"))
        .when(k == 3, F.concat(_word(name, "utf-8", "B"), F.lit(_CRLF + " "), _word(F.lit("größer"), "iso-8859-1", "Q")))
        .when(k == 4, F.concat(F.lit("re: "), _word(name, "utf-8", "Q"), F.lit(" end"))).otherwise(F.concat(F.lit("plain "), F.col("source")))
    )
    file = F.regexp_replace(coded, _CRLF, "")
    head = F.concat(F.lit("Subject: "), coded, F.lit(_CRLF + 'Content-Type: application/pdf; name="'), file,
                    F.lit('"' + _CRLF + 'Content-Disposition: attachment; filename="'), file, F.lit('"'))
    return docs.select("doc_id", F.col("doc_id").alias("file_id"), F.lit("x.eml").alias("filename"),
                       F.lit(1).cast("bigint").alias("file_size"), _mail(head, F.col("source")).alias("content"))


_NAME = "'Prüfung ' || doc_id || ' für ' || source"
_CODED = f"""CASE doc_id % 6 WHEN 0 THEN {_NAME} || ' – ✓' WHEN 3 THEN {_NAME} || 'größer' WHEN 4 THEN 're: ' || {_NAME} || ' end'
    WHEN 5 THEN 'plain ' || source ELSE {_NAME} END"""


@query("coded_subjects", f"SELECT doc_id, {_CODED} AS subject FROM documents")
def coded_subjects(spark, sf_dir):
    """Subjects without a parser: no Python runs."""
    return coded_headers_mail(spark, sf_dir).select("doc_id", decode_words(header("content", "Subject")).alias("subject"))


@query("coded_names", f"""SELECT doc_id, {_CODED} AS subject, {_CODED} AS raw_subject, {_CODED} AS first_name, {_CODED} AS raw_name,
    octet_length(encode(source)) AS size FROM documents""")
def coded_names(spark, sf_dir):
    """Subjects and attachment names of both message forms."""
    taken = mime.with_parts(coded_headers_mail(spark, sf_dir).select("doc_id", "content"))
    part = F.get("mime.parts", F.lit(0))
    return taken.select("doc_id", "mime.subject", "mime.raw_subject", part["filename"].alias("first_name"),
                        part["raw_filename"].alias("raw_name"), part["size"].alias("size"))


# Everything outside ASCII becomes one letter, so that each charset can hold it.
_SIMPLE = "regexp_replace(text, '[^\\x00-\\x7F]', 'é', 'g')"
_ENDED = "(CASE WHEN doc_id % 4 = 1 THEN 'x' || text || 'x' ELSE 'x' || " + _SIMPLE + " || 'x' END)"


@query("coded_bodies", f"""SELECT doc_id, md5(CASE doc_id % 4 WHEN 1 THEN {_ENDED} || chr(65533) WHEN 2 THEN replace({_ENDED}, 'é', chr(65533))
        WHEN 3 THEN replace({_ENDED}, 'é', chr(1081)) ELSE {_ENDED} END) AS first_md5,
    md5(CASE WHEN doc_id % 4 = 1 THEN {_ENDED} ELSE replace({_ENDED}, 'é', '') END) AS second_md5 FROM documents""")
def coded_bodies(spark, sf_dir):
    """Whole texts as bodies: iso-8859-1, a bad byte behind utf-8, an unknown charset, windows-1251.

    The first form reads the named charset, or utf-8 where it is unknown, with
    replacement marks; the second one reads utf-8 and leaves bad bytes out.
    """
    docs = table(spark, sf_dir, "documents")
    simple = F.regexp_replace("text", "[^\\x00-\\x7F]", "é")
    k = F.col("doc_id") % 4
    ended = F.concat(F.lit("x"), F.when(k == 1, F.col("text")).otherwise(simple), F.lit("x"))
    # é of iso-8859-1 is the byte that windows-1251 reads as й
    data = F.when(k == 1, F.concat(F.encode(ended, "UTF-8"), F.lit(b"\xff"))).otherwise(
        F.encode(F.when(k == 1, "").otherwise(ended), "ISO-8859-1"))
    charset = F.when(k == 0, "iso-8859-1").when(k == 1, "utf-8").when(k == 2, "no-such-set").otherwise("windows-1251")
    head = F.concat(F.lit("Content-Type: text/plain; charset="), charset, F.lit(_CRLF + "Content-Transfer-Encoding: base64"))
    mail = docs.select("doc_id", _mail(head, F.base64(data)).alias("content"))
    part = F.get("mime.parts", F.lit(0))
    return mime.with_parts(mail).select("doc_id", F.md5(part["text"].cast("binary")).alias("first_md5"),
                                        F.md5(part["utf8_text"].cast("binary")).alias("second_md5"))


def failing_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By ``doc_id % 5``: no content, a copy address that does not parse, a reply address that does not, and sound mail."""
    k = F.col("doc_id") % 5
    extra = F.when(k == 1, "Cc: <a@[b" + _CRLF).when(k == 2, "Reply-To: <a@[b" + _CRLF).otherwise("")
    head = F.concat(extra, F.lit("Subject: "), F.col("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").alias("file_id"), F.lit("x.eml").alias("filename"), F.lit(1).cast("bigint").alias("file_size"),
        F.when(k != 0, _mail(head, F.col("text"))).alias("content"))


_REASON = "CASE doc_id % 5 WHEN 0 THEN 'no content' WHEN 1 THEN 'unreadable header: cc' {} END"


@query("failed_messages", f"""SELECT * FROM (SELECT doc_id, {_REASON.format("")} AS first_reason,
    {_REASON.format("WHEN 2 THEN 'unreadable header: reply-to'")} AS second_reason FROM documents) WHERE second_reason IS NOT NULL""")
def failed_messages(spark, sf_dir):
    """Messages that fail in the second form, with each form's reason."""
    mail = failing_mail(spark, sf_dir)
    first = mime.parse_messages(mail.select("doc_id", "content")).select("doc_id", F.col("parse_error").alias("first_reason"))
    second = mime.parse_content(mail).select("doc_id", F.col("parse_error").alias("second_reason")).filter("second_reason is not null")
    return second.join(first, "doc_id").select("doc_id", "first_reason", "second_reason")


@query("failed_outcomes", """SELECT count(*) AS total_files, count(*) FILTER (doc_id % 5 > 2) AS successfully_parsed,
    count(*) FILTER (doc_id % 5 <= 2) AS failed FROM documents""")
def failed_outcomes(spark, sf_dir):
    return reports.parse_outcomes(mime.parse_content(failing_mail(spark, sf_dir)).select("parse_error"))


@query("small_files", """SELECT count(*) AS files, count(*) FILTER (n < 50) AS too_small,
    CAST(sum(CASE WHEN n >= 50 THEN n ELSE 0 END) AS BIGINT) AS bytes_kept
    FROM (SELECT 1 + octet_length(encode(CASE WHEN doc_id % 4 = 0 THEN source ELSE replace(text, chr(10), ' ') END)) AS n FROM documents)""")
def small_files(spark, sf_dir):
    """Files below 50 bytes, told from the listing alone; a quarter of the files holds a source name only.

    They are written by all cores however few row groups the table has.
    """
    text = F.when(F.col("doc_id") % 4 == 0, F.col("source")).otherwise(F.replace("text", F.lit("\n"), F.lit(" ")))
    folders = single_files(on_all_cores(table(spark, sf_dir, "documents")).select(text.alias("text")), "small-files")
    return sources.file_census(spark, folders, min_bytes=50)

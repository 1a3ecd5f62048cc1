"""Encoded words in the JVM against the standard library's mail parser."""

from __future__ import annotations

import base64
from email import message_from_bytes, policy

import pytest
from pyspark.sql import functions as F

from letterscope.functions import encoded_words


def b(text: str, charset: str = "utf-8") -> str:
    return f"=?{charset}?B?{base64.b64encode(text.encode(charset)).decode()}?="


def q(text: str, charset: str = "utf-8") -> str:
    return f"=?{charset}?q?{''.join(f'={x:02x}' if x > 122 or x < 48 else chr(x) for x in text.encode(charset))}?="


SUBJECTS = [
    "plain words", "a =? b ?= c", "=?utf-8?x?no way?=", "50 = 100 / 2",
    b("Büro 7 – Größe"), q("Büro 7 – Größe"), q("Grüße", "iso-8859-1"), b("Grüße", "ISO-8859-1"),
    b("Büro") + " " + q("Größe"), b("Büro") + "\r\n " + b("Größe") + " end", "begin " + b("Größe") + " end",
    "=?utf-8?q?two_words=3D?=", "=?utf-8?Q?bad=FFbyte?=", "=?us-ascii?Q?bad=FC_byte?=", q("5 €", "iso-8859-15"),
    b("5 € – “x”", "windows-1252"), b("a"), b("ab").replace("=?=", "?="), "=?utf-8*de?q?Gr=C3=B6=C3=9Fe?=", b("日本語 🙂"),
]


@pytest.mark.parametrize("fold", ["", "\r\n "])
def test_like_the_mail_parser(spark, fold):
    mails = [f"From: a@b.c\r\nX-Subject: no\r\nSubject: {fold}{s}\r\nTo: d@e.f\r\n\r\nSubject: not this\r\n".encode() for s in SUBJECTS]
    df = spark.createDataFrame([(i, bytearray(m)) for i, m in enumerate(mails)], "i int, content binary")
    found = df.select("i", encoded_words.decode_words(encoded_words.header("content", "Subject")).alias("s")).orderBy("i").collect()
    expected = [message_from_bytes(m, policy=policy.default)["Subject"] for m in mails]
    assert [r.s.strip() for r in found] == [e.strip() for e in expected]


def test_absent_and_unknown(spark):
    rows = [(None,), (bytearray(b""),), (bytearray(b"From: x\n\nSubject: body"),), (bytearray(b"subject:  low \nA: b"),),
            (bytearray(b"Subject: =?koi8-r?B?8NLJ18XU?= x\n\n"),), (bytearray(b"Subject:\n\n"),)]
    df = spark.createDataFrame(rows, "content binary").coalesce(1)
    text = encoded_words.header("content", "Subject")
    found = df.select(text.alias("raw"), encoded_words.decode_words(text).alias("s")).collect()
    assert [tuple(r) for r in found] == [
        (None, None), (None, None), (None, None), ("low", "low"), ("=?koi8-r?B?8NLJ18XU?= x", None), ("", "")]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(bytearray(b""),)], "content binary")
    plan = df.select(encoded_words.decode_words(encoded_words.header("content", "Subject")).alias("s"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")
    assert plan.filter(F.col("s").isNotNull()).count() == 0

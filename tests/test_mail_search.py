"""Search in parsed mail, and the summary written as JSON."""

import json
import os

from pyspark.sql import functions as F

from letterscope.operators import mail_search, reports

CONTENT = ("id int, metadata struct<`from`: string, `to`: string, subject: string>, body struct<text: string, html: string>")
MAIL = [
    (1, ("ann@corp.example", "bob@corp.example", "Quarterly report"), ("the report is here", None)),
    (2, ("bob@corp.example", "ann@corp.example", "Re: Quarterly report"), (None, "<p>thanks Ann</p>")),
    (3, (None, None, None), ("report report, REPORT", None)),
    (4, ("eve@other.example", "ann@corp.example", ""), ("", None)),
]
QUERIES = [
    (1, "Quarterly REPORT", True, None), (2, "quarterly report", False, None), (3, "the of", True, None), (4, "ann", True, ["from", "to"]),
    (5, "ann thanks", True, None), (6, "report", False, ["text"]), (7, None, True, None), (8, "report report", True, None),
]


def found(spark, mail=MAIL, queries=QUERIES):
    terms = mail_search.mail_terms(spark.createDataFrame(mail, CONTENT), "id")
    asked = spark.createDataFrame(queries, "query_id int, query string, wants_all boolean, fields array<string>")
    return sorted(tuple(r) for r in mail_search.search(terms, "id", asked).select("query_id", "id", "terms_met", "occurrences").collect())


def test_many_queries_at_once(spark):
    assert found(spark) == [
        (1, 1, 2, 3), (1, 2, 2, 2), (2, 1, 2, 3), (2, 2, 2, 2), (2, 3, 1, 3), (4, 1, 1, 1), (4, 2, 1, 1), (4, 4, 1, 1),
        (5, 2, 2, 3), (6, 1, 1, 1), (6, 3, 1, 3), (8, 1, 1, 2), (8, 2, 1, 1), (8, 3, 1, 3)]


def test_nothing_to_search_or_to_ask(spark):
    assert found(spark, mail=[]) == [] == found(spark, queries=[])


def test_only_asked_terms_are_counted(spark):
    mail = spark.createDataFrame(MAIL + MAIL[:1], CONTENT)
    asked = spark.createDataFrame(QUERIES, "query_id int, query string, wants_all boolean, fields array<string>")
    some, every = mail_search.mail_terms(mail, "id", queries=asked), mail_search.mail_terms(mail, "id")
    assert {r["term"] for r in some.collect()} == {"quarterly", "report", "ann", "thanks"} < {r["term"] for r in every.collect()}
    results = [sorted(map(tuple, mail_search.search(terms, "id", asked).collect())) for terms in (some, every)]
    assert results[0] == results[1] != []
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning(id")  # printed from the top down


def test_summary_file(spark, tmp_path):
    attachment = "array<struct<filename: string>>"
    rows = [(None, None, ("a@b.c", "d@e.f")), ("broken", None, None), (None, [("x",), ("y",)], ("a@b.c", ""))]
    content = spark.createDataFrame(rows, f"parse_error string, attachments {attachment}, metadata struct<`from`: string, `to`: string>")
    reports.write_summary(content, str(tmp_path / "s"), F.lit("2025-01-02 03:04:05").cast("timestamp"))
    parts = [f for f in os.listdir(tmp_path / "s") if f.startswith("part")]
    assert len(parts) == 1
    assert json.loads((tmp_path / "s" / parts[0]).read_text()) == {
        "total_files": 3, "successfully_parsed": 2, "failed": 1, "with_attachments": 1, "total_attachments": 2,
        "unique_senders": 1, "unique_recipients": 1, "parsing_time": "2025-01-02T03:04:05.000000"}

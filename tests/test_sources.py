import json
import os

import pytest
from pyspark.sql import functions as F

from letterscope.operators import loading, ordinals, reports
from letterscope.operators.frames import frame_records, tls_sessions, starttls_frames, undot
from letterscope.plans import pipelines
from letterscope.schemas import CONTENT, MESSAGE, TRAFFIC_DOCUMENT
from letterscope.sources import documents, text_exports


def write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_frame_export(spark, tmp_path):
    lines = [
        "1.5|10.0.0.1|1024|10.0.0.2|25|STARTTLS||||||66|", "2|a|x|b|25|| starttls |p|250|ok|10|66|22",
        "1|2|3|4", "1|s|1||25", "abc|s|1|d|25", "3|s|1|d|25", "", "4|s|1|d|25||||250-|a|b|c|22",
    ]
    rows = frame_records(text_exports.read_frame_export(spark, write(tmp_path / "e.txt", "\n".join(lines)))).collect()
    got = {r["timestamp"]: r for r in rows}
    assert sorted(got) == [1.5, 2.0, 3.0, 4.0]
    assert got[1.5]["is_starttls"] and got[2.0]["is_starttls"] and not got[3.0]["is_starttls"]
    assert got[2.0]["src_port"] is None and got[2.0]["smtp_response_code"] == 250
    assert got[3.0]["tcp_len"] is None and got[4.0]["smtp_response_code"] is None
    assert got[4.0]["tcp_len"] is None and got[4.0]["smtp_response"] == "a"


def test_ragged_csv(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    for i in range(3):
        write(folder / f"{i}.csv", 'a.b,c,d\n1,"x\n  \n2,y,z,more,"q"\n\\,\'t\',\n')
    df = text_exports.read_ragged_csv(spark, str(folder))
    assert df.columns == ["a.b", "c", "d"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == sorted([("1", '"x', ""), ("2", "y", 'z,more,"q"'), ("\\", "'t'", "")] * 3)


def test_quoted_csv(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n"x, ""y""",2\n,"line\nbreak"\n')
    rows = [tuple(r) for r in text_exports.read_quoted_csv(spark, path, ["a", "b"]).collect()]
    assert rows == [('x, "y"', "2"), ("", "line\nbreak")]


def test_sessions(spark, tmp_path):
    head = " ip.src,ip.dst , tcp.srcport,tcp.dstport,smtp.req.command,smtp.req.parameter"
    body = "a,b,1,25,STAR,TLS\na,b,1,25,star,tls\nb,a,25,1,STAR,TLS\na,b,1,25,STARTTLS,\nc,d,1,25,,TLS\n"
    schema = ", ".join(f"`{c}` string" for c in head.split(","))
    df = text_exports.read_session_csv(spark, write(tmp_path / "s.csv", head + "\n" + body), schema)
    assert undot(df).columns[:2] == ["ip_src", "ip_dst"]
    assert starttls_frames(df).count() == 3 and tls_sessions(df).count() == 2
    counts = {r[0]: r[1] for r in reports.value_counts(df, "`smtp.req.command`").collect()}
    assert counts == {"STAR": 2, "star": 1, "STARTTLS": 1}


def test_line_numbers_across_splits(spark, tmp_path):
    for name in "ab":
        write(tmp_path / f"{name}.txt", "".join(f"{name}{i}\n\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = text_exports.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 6000
    assert all(r["value"] == f"{r['file_name'][0]}{r['line_no']}" for r in rows)


def test_bulk_file(spark, tmp_path):
    def pair(i, doc):
        return json.dumps({"index": {"_index": "t", "_id": str(i)}}) + "\n\n" + doc + "\n"

    text = pair(1, '{"index": "x", "source_ip": "a"}') + pair(2, "{broken") + pair(1, '{"source_ip": "b"}')
    path = write(tmp_path / "b.json", text + '{"index":{"_index":"t","_id":"9"}}')
    rows = text_exports.read_bulk_file(spark, path, TRAFFIC_DOCUMENT).orderBy("pair_no").collect()
    assert [(r["_id"], r["problem"]) for r in rows] == [
        ("1", None), ("2", "unreadable document"), ("1", None), ("9", "action without document")]
    good = text_exports.read_bulk_file(spark, path, TRAFFIC_DOCUMENT).filter("problem is null")
    assert [r["_source"]["source_ip"] for r in loading.last_write(good, "_id", "pair_no").collect()] == ["b"]


def test_bulk_write_ends_lines_and_drops_nulls(spark, tmp_path):
    docs = spark.createDataFrame([("1", None, 5), ("2", "é", None)], "_id string, a string, b int")
    out = str(tmp_path / "bulk")
    loading.write_bulk_file(loading.bulk_pairs(docs.coalesce(1), "t"), out)
    text = "".join(open(f"{out}/{f}", encoding="utf-8").read() for f in os.listdir(out) if f.startswith("part"))
    assert text.endswith("\n")
    assert [json.loads(x) for x in text.splitlines()] == [
        {"index": {"_index": "t", "_id": "1"}}, {"b": 5}, {"index": {"_index": "t", "_id": "2"}}, {"a": "é"}]


def test_message_files(spark, tmp_path):
    mail = "Subject: x\r\nTo: a@b.c\r\n\r\n" + "long enough body " * 4
    write(tmp_path / "one.eml", mail)
    write(tmp_path / "two", mail)
    write(tmp_path / "small.eml", "Subject: s\r\n\r\n")
    assert {r["filename"] for r in documents.read_messages(spark, str(tmp_path), min_bytes=50).collect()} == {"one.eml", "two"}
    rows = pipelines.content_from_files(spark, str(tmp_path)).orderBy("file_id").collect()
    assert [(r["file_id"], r["filename"]) for r in rows] == [(0, "one.eml"), (1, "small.eml")]
    assert rows[0]["email_hash"] and rows[1]["body"]["text"] == "" and not rows[1]["has_attachments"]
    plan = documents.read_messages(spark, str(tmp_path), min_bytes=50)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(length,50)" in plan


def test_json(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"subject": "x", "to": ["a"]}, {"subject": "é"}], indent=2))
    assert [r["subject"] for r in documents.read_json_array(spark, path, MESSAGE).collect()] == ["x", "é"]
    write(tmp_path / "bad.json", '[{"subject": ')
    with pytest.raises(Exception):
        documents.read_json_array(spark, str(tmp_path / "bad.json"), MESSAGE).collect()
    with pytest.raises(Exception):
        documents.read_json_array(spark, str(tmp_path / "missing.json"), MESSAGE).collect()


def test_json_files_and_reports(spark, tmp_path):
    def doc(i, **more):
        write(tmp_path / f"{i:04}.json", json.dumps({"file_id": i, **more}, indent=1))

    doc(0, has_attachments=True, attachments=[{"filename": "z"}])
    doc(1, has_attachments=True, attachments=[{"filename": "a"}, {"size": 3}], metadata={"from": "f"})
    doc(2, has_attachments=False, attachments=[])
    doc(3)
    write(tmp_path / "0004.json", "{oops")
    schema = CONTENT.replace("email_hash string", "email_hash string, has_attachments boolean")
    df = documents.read_json_files(spark, str(tmp_path), schema).withColumn("filename", F.col("source_file"))
    assert df.filter("source_file = '0004.json' and file_id is not null").count() == 0
    df = df.filter("file_id is not null")
    assert reports.flag_counts(df, "filename").first().asDict() == {"flag_true": 2, "flag_false": 1, "checked": 4}
    assert [r[0] for r in reports.attachment_ids(df).collect()] == [1]
    assert reports.attachment_id_counts(df).first().asDict() == {"unique_ids": 3, "ids_with_attachments": 1}
    ids = spark.createDataFrame([(0,), (1,), (2,), (1036,)], "file_id bigint")
    status = {r[0]: r[1] for r in reports.id_status(ids, df).collect()}
    assert status == {0: "NOT FOUND", 1: "EXISTS", 2: "NOT FOUND", 1036: "NOT FOUND"}
    report = {r["File ID"]: r for r in loading.attachment_report(df).collect()}
    assert report[1]["Attachment Names"] == "a, unknown" and report[3]["From"] == "N/A"
    assert ordinals.with_ordinal(df.select("filename"), "filename").count() == 4


def test_single_files_are_written_by_all_cores(spark, tmp_path):
    """A table of one row group; what is written lies in one folder, named by the task that wrote it."""
    from letterscope.catalog import letters

    rows = [(i, f"text {i}", "en", "s", 6) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    path = letters.message_files(spark, str(tmp_path))
    names = [r["filename"] for r in documents.read_messages(spark, path, "part-*").collect()]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) == spark.sparkContext.defaultParallelism
    found = letters.QUERIES["scan_eml"](spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(40))

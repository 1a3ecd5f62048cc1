"""Shapes of plans and behaviour under skew."""

import pytest
from pyspark.sql import functions as F

from letterscope import staging
from letterscope.catalog.adapters import table
from letterscope.functions import search
from letterscope.operators import loading, ordinals, reports
from letterscope.plans import pipelines
from letterscope.sources import text_exports
from letterscope.streaming.incremental import load_new_exports


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordinals_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    rows = ordinals.with_ordinal(df, "k", partitions=5).collect()
    assert all(r["ordinal"] == r["k"] for r in rows) and len(rows) == 5000


def test_positional_join_keeps_extra_messages(spark):
    left = ordinals.with_ordinal(spark.range(5).withColumnRenamed("id", "m"), "m")
    right = ordinals.with_ordinal(spark.range(10, 13).withColumnRenamed("id", "f"), "f")
    rows = {r["m"]: r["f"] for r in ordinals.positional_join(left, right).collect()}
    assert rows == {0: 10, 1: 11, 2: 12, 3: None, 4: None}


def test_last_write_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("_id"), "id")
    latest = loading.last_write(df, "_id", "id")
    plan = plan_of(latest)
    assert "WindowGroupLimit" in plan and plan.index("Partial") > plan.index("Final")
    assert sorted(r["id"] for r in latest.collect()) == [997, 998, 999]


def test_hot_attachment(spark):
    one = F.array(F.struct(F.lit("n").alias("filename"), F.lit(2).cast("bigint").alias("size"), F.lit("h").alias("sha256")))
    df = spark.range(2000).select(F.col("id").alias("m"), one.alias("attachments"))
    assert reports.attachment_occurrence(df, "m").first().asDict() == {
        "sha256": "h", "messages": 2000, "copies": 2000, "total_bytes": 4000}


def test_search_reads_needed_columns_only(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    plan = plan_of(docs.filter(search.matches_any("text", "license")).select("doc_id"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "Python" not in plan


def test_keyword_filter_is_pushed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.col("source") == "src1")
    assert "EqualTo(source,src1)" in plan_of(docs)


def test_checks_reject_single_rows(spark):
    rows = [(1, "junk", "10.0.0.1"), (2, None, "10.0.0.1"), (3, "2025-07-28", "bad"), (4, "1753692672000", None), (5, None, "::1")]
    df = loading.check_documents(spark.createDataFrame(rows, "i int, date string, ip string"), "date", "ip")
    assert {r["i"]: r["reason"] for r in df.collect()} == {
        1: "bad date: date", 2: None, 3: "bad ip: ip", 4: None, 5: None}
    assert [r["i"] for r in reports.first_failures(df, "i").collect()] == [1, 3]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "_id string, v int, n int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "_id string, v int, n int")
    assert {r["_id"]: r["v"] for r in loading.upsert(old, new, "_id", "n").collect()} == {"a": 1, "b": 3, "c": 4}


def test_shared_folder(spark):
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        staging.shared_dir(Cluster)


HEADER = ("frame.time_epoch,ip.src,ip.dst,tcp.srcport,tcp.dstport,smtp.req.command,smtp.req.parameter,"
          "smtp.response.code,smtp.response,cflow.pie.ntop.smtp.mail_from,cflow.pie.ntop.smtp.rcpt_to,smtp.message")


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(2):
        (source / f"{i}.csv").write_text(HEADER + f"\n{i}.5,10.0.0.{i},9.9.9.9,1,465,MAIL,FROM:<a@b.co>\nabc,x\n,y,,,,\n")
        load_new_exports(spark, str(source), HEADER.split(","), out, str(tmp_path / "progress")).awaitTermination()
    batch = pipelines.traffic_from_csv(spark, str(source))
    assert sorted(map(str, spark.read.parquet(out).select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert batch.count() == 4 and text_exports.export_header(spark, str(source)) == HEADER.split(",")


def test_mail_documents_from_files(spark, tmp_path):
    mails, export = tmp_path / "mails", tmp_path / "export.txt"
    mails.mkdir()
    for i in range(3):
        (mails / f"{i}").write_text(f"Subject: s{i}\r\nContent-Type: text/html\r\n\r\n<html><b>body {i}</b> long enough text</html>")
    export.write_text("".join(f"{9 - i}|10.0.0.{i}|1|8.8.8.8|25\n" for i in range(2)))
    rows = pipelines.mail_documents_from_files(spark, str(mails), str(export)).orderBy("path").collect()
    assert [r["message"]["body_text"] for r in rows] == [f"body {i} long enough text" for i in range(3)]
    assert [r["network"]["source"]["ip"] for r in rows] == ["10.0.0.0", "10.0.0.1", None]
    assert rows[0]["network"]["source"]["is_private"] and rows[2]["network"]["destination"]["is_private"] is None


def test_key_filters_stay_below_the_parser(spark, sf_dir):
    from letterscope.catalog import letters

    plan = plan_of(letters.QUERIES["messages_by_id"](spark, sf_dir))
    assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [Or" in plan, plan


def test_frames_are_spread_before_they_are_cleaned(spark, sf_dir):
    from letterscope.catalog import traffic

    assert "RoundRobinPartitioning" in plan_of(traffic.classified(spark, sf_dir))
    assert "RoundRobinPartitioning" in plan_of(traffic.records(spark, sf_dir))


def test_a_time_range_works_out_the_time_once(spark):
    from letterscope.functions.text import epoch_ts, to_double

    df = spark.createDataFrame([(1, "10.5"), (2, "20"), (3, "x"), (4, None), (5, "15")], "i int, v string")
    timed = df.select("i", epoch_ts(to_double("v")).alias("t"))
    start, end = (F.timestamp_seconds(F.lit(n)) for n in (10, 15))
    found = reports.discover(timed, "t", start, end, "i")
    assert [r["i"] for r in found.collect()] == [5, 1]
    condition = next(x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x)
    assert condition.count("regexp_extract") <= 1

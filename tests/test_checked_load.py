"""Checked loads: what is stored, counted and reported; canonical JSON texts; positions by keys."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from letterscope.catalog import letters
from letterscope.functions import canonical
from letterscope.operators import checked_load, ordinals


def frame(spark, rows):
    return spark.createDataFrame(rows, "i int, date string, ip string")


def test_rows_are_split_and_counted_in_one_job(spark, tmp_path):
    rows = [(i, "junk" if i % 10 == 0 else None, "nope" if i % 15 == 1 else "10.0.0.1" if i % 2 else None) for i in range(100)]
    checks = checked_load.bad_date("date") | checked_load.bad_ips("ip")
    loaded = checked_load.checked_load(frame(spark, rows), str(tmp_path / "t"), checks)
    bad_dates, bad_ips = {i for i in range(100) if i % 10 == 0}, {i for i in range(100) if i % 15 == 1 and i % 10}
    assert loaded.reasons == {"bad date: date": len(bad_dates), "bad ip: ip": len(bad_ips)}
    assert loaded.accepted == 100 - loaded.rejected
    assert {r["i"] for r in loaded.rows(spark, accepted=False).collect()} == bad_dates | bad_ips
    assert loaded.rows(spark, accepted=True).filter("reason is not null").count() == 0
    assert [r["i"] for r in loaded.first_failures(spark, "i").collect()] == sorted(bad_dates | bad_ips)[:5]
    stored = {(r["accepted"], r["reason"]): r["n"] for r in loaded.outcomes(spark).collect()}
    assert stored == {(True, None): loaded.accepted, **{(False, k): n for k, n in loaded.reasons.items()}}
    # Reading the rejected rows alone opens no file of the accepted ones.
    assert all("accepted=false" in f for f in loaded.rows(spark, accepted=False).inputFiles()) or \
        "PartitionFilters: [isnotnull(accepted" in loaded.rows(spark, accepted=False)._jdf.queryExecution().executedPlan().toString()


def test_nothing_to_load(spark, tmp_path):
    loaded = checked_load.checked_load(frame(spark, []), str(tmp_path / "t"), checked_load.bad_ips("ip"))
    assert (loaded.accepted, loaded.rejected) == (0, 0) and loaded.rows(spark).collect() == [] == loaded.outcomes(spark).collect()


def test_content_form(spark, sf_dir):
    content = letters.named_content(spark, sf_dir).withColumn("place", F.col("doc_id"))
    fixed = F.lit("2025-01-02 03:04:05").cast("timestamp")
    docs = checked_load.content_documents(content, F.col("place"), fixed)
    row = docs.filter("file_id = 6").first()
    assert row["metadata"]["date"] == "2024-01-01T00:06:00+00:00" and str(row["parsed_at"]) == "2025-01-02 03:04:05"
    assert len(row["_id"]) == 32 and "parse_error" not in row and row["body_length"] == len(row["body"]["text"])


TEXTS = ["", "plain", 'say "hi" \\ there', "tab\tline\nfeed\r\x08\x0c", "\x00\x1f\x7f", "é ü 字", "😀 mixed é", "\\u00e9 \\n", "/", "a" * 5000 + "é"]


def test_json_texts_are_those_of_the_standard_library(column):
    assert column(TEXTS, canonical.json_text("v")) == [json.dumps(t) for t in TEXTS]
    assert column([None], canonical.json_text("v")) == [None]


def test_json_of_nested_values(spark):
    df = spark.createDataFrame([({"b": "é", "a": None, "B": 'x"'}, ["q", None], None, 5)], "m map<string,string>, l array<string>, s string, n bigint")
    shown = canonical.json_object({"m": canonical.json_map("m"), "l": canonical.json_list("l", canonical.json_text),
                                   "s": canonical.json_text("s"), "n": canonical.json_number("n")})
    expected = {"m": {"b": "é", "a": None, "B": 'x"'}, "l": ["q", None], "s": None, "n": 5}
    assert df.select(shown).first()[0] == json.dumps(expected, sort_keys=True)
    left_out = canonical.json_object({"s": canonical.json_text("s"), "n": canonical.json_number("n")}, keep_nulls=False)
    assert df.select(left_out).first()[0] == '{"n": 5}'
    assert df.select(F.md5(F.encode(shown, "UTF-8"))).first()[0] == hashlib.md5(json.dumps(expected, sort_keys=True).encode()).hexdigest()


@pytest.mark.parametrize(("name", "times"), [("positional_join", 0), ("final_docs", 1)])
def test_the_parser_runs_once_at_most(spark, sf_dir, name, times):
    plan = letters.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [run(content#") == times


def test_email_hash_needs_no_second_python_step(spark, sf_dir):
    plan = letters.QUERIES["email_hash"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_positions_are_worked_out_on_keys(spark):
    left = spark.range(7).select((F.col("id") * 3 % 7).alias("m"), F.lit("wide").alias("text"))
    right = spark.range(4).select((F.col("id") + 10).alias("f"), (F.col("id") % 2).alias("g"))
    pairs = ordinals.positional_pairs(left, "m", right, "f", "g")
    rows = {r["m"]: (r["f"], r["g"]) for r in pairs.collect()}
    assert rows == {0: (10, 0), 1: (11, 1), 2: (12, 0), 3: (13, 1), 4: (None, None), 5: (None, None), 6: (None, None)}
    assert "text" not in pairs.columns

"""Readers of records that span lines, with files cut into many splits."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from letterscope.sources import documents, text_exports
from letterscope.sources.split_records import records

_R = random.Random(4)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


HEADER = ["a.b", "c", "d"]


def some_csv(rows, end):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerows([HEADER, *rows])
    return out.getvalue()


def cell():
    return "".join(_R.choice(["x", "y z", '"', ",", "\n", "é", "'", "12", ""]) for _ in range(_R.randint(0, 9)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_over_many_splits(spark, tmp_path, small_splits, end):
    files = {}
    for name in "pq":
        rows = [[f"{name}{i}", cell(), cell()] for i in range(150)]
        rows += [[f"{name}long", "line\n" * 400, 'say "hi"']]
        files[name] = rows
        write(tmp_path / f"{name}.csv", some_csv(rows, end))
    read = text_exports.read_quoted_csv(spark, str(tmp_path), HEADER)
    found = sorted(map(tuple, read.collect()))
    assert found == sorted(tuple(r) for rows in files.values() for r in rows)
    whole = spark.read.csv(str(tmp_path), header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST",
                           schema=", ".join(f"`{h}` string" for h in HEADER)).na.fill("")
    assert found == sorted(map(tuple, whole.collect()))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_a_quote_left_open_is_an_error(spark, tmp_path, small_splits):
    path = write(tmp_path / "x.csv", some_csv([["1", "2", "3"]] * 100, "\n") + '"never closed,1,2\n')
    with pytest.raises(Exception, match="quote is not closed"):
        text_exports.read_quoted_csv(spark, path, HEADER).collect()


def some_value(depth):
    kind = _R.randint(0, 6 if depth else 4)
    text = "".join(_R.choice(['"', "\\", "}", "{", "[", "]", "},{", "],[{", "é", "\n", "\\u00e9", "a"]) for _ in range(_R.randint(0, 12)))
    if kind <= 2:
        return text
    if kind == 3:
        return _R.randint(-5, 5)
    if kind == 4:
        return None
    if kind == 5:
        return [some_value(depth - 1) for _ in range(_R.randint(0, 3))]
    return {f"k{i}": some_value(depth - 1) for i in range(_R.randint(0, 3))}


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_over_many_splits(spark, tmp_path, small_splits, indent):
    expected = []
    for name in "pqr":
        rows = [{"id": f"{name}{i}", "text": some_value(0) if i % 3 else "],[{" * 200, "more": {"deep": some_value(2)}} for i in range(80)]
        for r in rows:
            r["text"] = r["text"] if isinstance(r["text"], str) else "other"
            r["more"] = json.dumps(r["more"])
        expected += [(r["id"], r["text"], r["more"]) for r in rows]
        write(tmp_path / f"{name}.json", json.dumps(rows, indent=indent, ensure_ascii=name == "p"))
    write(tmp_path / "empty.json", " [ ]\n")
    schema = "id string, text string, more string"
    read = documents.read_json_array(spark, str(tmp_path), schema)
    found = sorted(map(tuple, read.collect()))
    assert found == sorted(expected)
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path))
    assert found == sorted(map(tuple, whole.filter("id is not null").collect()))


def test_nested_objects_stay_whole(spark, tmp_path, small_splits):
    rows = [{"id": i, "inner": {"list": [{"x": j} for j in range(i % 7)], "s": "}{" * i}} for i in range(60)]
    path = write(tmp_path / "n.json", json.dumps(rows))
    read = documents.read_json_array(spark, path, "id int, inner struct<list: array<struct<x: int>>, s: string>")
    assert sorted((r["id"], len(r["inner"]["list"]), r["inner"]["s"]) for r in read.collect()) == [(i, i % 7, "}{" * i) for i in range(60)]


@pytest.mark.parametrize("text", [
    '[{"id": 1}, {"id": ', '[{"id": 1}', '[{"id": 1} {"id": 2}]', '{"id": 1}', '[{"id": 1}]]', '[{"id": 1}], [{"id": 2}]',
    '[{"id": 1}, 5]', '[{"id": "a}, {"id": 2}]', '[[{"id": 1}]]', '[{"id": 1},, {"id": 2}]', '[{"id": 1},]', '[{"id" 1}]',
])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    path = write(tmp_path / "bad.json", text)
    with pytest.raises(Exception):
        documents.read_json_array(spark, path, "id string").collect()


def test_bulk_pairs_over_many_splits(spark, tmp_path, small_splits):
    for name in "pq":
        lines = []
        for i in range(200):
            lines.append(json.dumps({"index": {"_index": "t", "_id": f"{name}{i}"}}))
            lines += [""] * (i % 3) + [json.dumps({"n": i, "pad": "x" * (i % 90)}) if i % 10 else "{broken"]
        lines.append('{"index": {"_index": "t", "_id": "alone"}}')
        write(tmp_path / f"{name}.ndjson", "\n".join(lines) + "\n")
    rows = text_exports.read_bulk_file(spark, str(tmp_path), "n int, pad string").collect()
    assert len(rows) == 2 * 201
    for r in rows:
        name, i = r["file_name"][0], r["pair_no"]
        if i == 200:
            assert (r["_id"], r["problem"]) == ("alone", "action without document")
        elif i % 10 == 0:
            assert (r["_id"], r["problem"]) == (f"{name}{i}", "unreadable document")
        else:
            assert (r["_id"], r["_source"]["n"], r["problem"]) == (f"{name}{i}", i, None)


def test_only_records_at_split_borders_move(spark, tmp_path, small_splits):
    path = write(tmp_path / "m.csv", some_csv([[str(i), "v", "w"] for i in range(2000)], "\n"))
    lines = text_exports.pieces(spark, path)
    splits = lines.select("file_path", "split_start").distinct().count()
    zero = F.lit(0)
    cut = records(lines.select("*", F.lit(0).alias("flips"), zero.alias("if_even"), zero.alias("if_odd")), "\n")
    rows = cut.collect()
    assert len(rows) == 2001
    # Those with a value in ``rest`` went through the exchange: the first of each split.
    assert sum(r["rest"] is not None for r in rows) == splits > 8

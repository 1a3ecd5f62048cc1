"""Records written as files of their own, and many small files read back."""

import glob
import os

import pytest

from letterscope import staging
from letterscope.catalog import coded_mail, letters
from letterscope.sources import documents


@pytest.fixture
def shared(monkeypatch):
    """Sets the shared folder for one test."""
    return lambda place: monkeypatch.setattr(staging, "shared_dir", lambda spark: place)


def contents(folders):
    return sorted(open(f, "rb").read() for x in folders for f in glob.glob(x.removeprefix("file:") + "/part-*"))


TEXTS = [None, "", "plain", "two\nlines\r\n", "é – ✓", "x" * 100_000] * 4


def test_files_equal_those_of_sparks_writer(spark, tmp_path, shared, monkeypatch):
    monkeypatch.setattr(staging, "FOLDER_FILES", 2)
    shared(f"file://{tmp_path}/my shared")
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    folders = staging.single_files(texts, "some")
    written = [os.listdir(x.removeprefix("file://")) for x in folders]
    assert max(len(x) for x in written) <= 2 and len({n for x in written for n in x}) == len(TEXTS)
    texts.repartition(1).write.option("maxRecordsPerFile", 1).text(str(tmp_path / "spark"))
    assert contents(folders) == contents([str(tmp_path / "spark")])
    read = documents.read_messages(spark, folders)
    assert sorted(bytes(r["content"]) for r in read.collect()) == contents(folders)


def test_files_in_a_store_that_only_hadoop_opens(spark, tmp_path, shared):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.letters.link./in", f"file://{tmp_path}")
    shared("viewfs://letters/in")
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    folders = staging.single_files(texts, "some")
    assert sorted(r["file_size"] for r in documents.read_messages(spark, folders).collect()) == sorted(
        len((t or "").encode()) + 1 for t in TEXTS)


def test_no_texts(spark):
    none = spark.createDataFrame([], "text string")
    assert documents.read_messages(spark, staging.single_files(none, "none")).count() == 0


def test_rows_move_only_where_few_partitions_hold_them(spark):
    def moved(table):
        return "Exchange" in staging.on_all_cores(table)._jdf.queryExecution().executedPlan().toString()

    cores = spark.sparkContext.defaultParallelism
    assert moved(spark.range(0, 800, 1, 1)) and moved(spark.range(0, 800, 1, cores).filter("id < 100"))
    assert not moved(spark.range(0, 800, 1, cores)) and not moved(spark.range(0, 800, 1, 5 * cores))
    assert staging.on_all_cores(spark.range(0)).count() == 0 and staging.on_all_cores(spark.range(3)).count() == 3


def test_a_task_reads_many_small_files(spark, tmp_path):
    """Spark gives a task 32 of them."""
    n = 8 * spark.sparkContext.defaultParallelism
    for i in range(40 * n):
        (tmp_path / f"{i}.json").write_text(f'{{"file_id": {i}}}')
    read = documents.read_messages(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() == n and read.count() == 40 * n
    objects = documents.read_json_files(spark, str(tmp_path), "file_id bigint")
    assert objects.rdd.getNumPartitions() == n
    assert sorted(r["file_id"] for r in objects.collect()) == list(range(40 * n))
    census = documents.file_census(spark, str(tmp_path), min_bytes=16)
    assert "Coalesce" in census._jdf.queryExecution().executedPlan().toString()
    assert census.first().asDict() == {"files": 40 * n, "too_small": 100, "bytes_kept": sum(13 + len(str(i)) for i in range(100, 40 * n))}


@pytest.mark.parametrize("name", ["scan_eml", "scan_json_glob", "scan_messages", "small_files"])
def test_one_file_a_document(spark, tmp_path, shared, name):
    """No process to set a file's mode, no file beside the documents' own, also where tasks have none; content moves once."""
    shared(f"file://{tmp_path}/shared")
    rows = [(i, f"text {i}", "en", "s", 6) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = (letters.QUERIES | coded_mail.QUERIES)[name](spark, str(tmp_path))
    written = [f for _, _, names in os.walk(tmp_path / "shared") for f in names]
    assert len(written) == 3 and all(f.startswith("part-") for f in written)
    assert "RoundRobin" not in found._jdf.queryExecution().executedPlan().toString()
    if name == "small_files":
        assert found.first()["files"] == 3
    else:
        assert sorted(r["doc_id"] for r in found.collect()) == [0, 1, 2]

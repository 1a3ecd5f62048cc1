"""Upserts into a stored table."""

import os
import random

import pytest

from letterscope.operators.keyed_table import ConcurrentChange, KeyedTable

SCHEMA = "id string, n int, text string"


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[full] = (os.stat(full).st_mtime_ns, os.path.getsize(full))
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch(spark, values):
    return spark.createDataFrame(values, SCHEMA + ", seq int")


def test_upserts_in_a_row(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable.create(spark, path, SCHEMA, "id", buckets=8)
    assert rows(table.read()) == []
    rng, expected, seq = random.Random(3), {}, 0
    for step in range(4):
        values, inserted, updated = [], set(), set()
        for _ in range(60):
            key = f"k{rng.randint(0, 90)}"
            seq += 1
            values.append((key, seq * 10, f"step {step}", seq))
        for key, n, text, _ in values:
            (updated if key in expected else inserted).add(key)
        for key, n, text, _ in values:
            expected[key] = (key, n, text)
        rng.shuffle(values)
        done = table.upsert(batch(spark, values), "seq")
        assert (done.version, done.inserted, done.updated) == (step + 1, len(inserted), len(updated))
        assert rows(table.read()) == sorted(expected.values(), key=str)
    assert rows(table.lookup(["k1", "k2", "nope"])) == sorted((expected[k] for k in ("k1", "k2") if k in expected), key=str)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable.create(spark, path, SCHEMA, "id", buckets=16)
    table.upsert(batch(spark, [(f"k{i}", i, "old", 1) for i in range(200)]), "seq")
    before, held = files(path), table.manifest()["held"]
    done = table.upsert(batch(spark, [("k7", -7, "new", 2), ("k7", -8, "newer", 3)]), "seq")
    after = files(path)
    assert done.buckets == 1 and (done.inserted, done.updated) == (0, 1)
    assert {f: s for f, s in after.items() if f in before} == before
    changed = {b for b, v in table.manifest()["held"].items() if held[b] != v}
    assert len(changed) == 1 and all("/data/2-" in f and f"bucket={min(changed)}/" in f for f in set(after) - set(before))
    assert ("k7", -8, "newer") in rows(table.read()) and table.read().count() == 200


def test_readers_see_one_version(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=4)
    table.upsert(batch(spark, [("a", 1, "x", 1), ("b", 2, "x", 1)]), "seq")
    opened = table.read()
    table.upsert(batch(spark, [("a", 9, "y", 1), ("c", 3, "y", 1)]), "seq")
    assert rows(opened) == rows(table.read(1)) == [("a", 1, "x"), ("b", 2, "x")]
    assert rows(table.read()) == [("a", 9, "y"), ("b", 2, "x"), ("c", 3, "y")]


def test_an_upsert_that_dies_changes_nothing(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=4)
    table.upsert(batch(spark, [("a", 1, "x", 1)]), "seq")
    with pytest.raises(Exception, match="null in key column"):
        table.upsert(batch(spark, [("b", 1, "x", 1), (None, 2, "x", 1)]), "seq")
    assert rows(table.read()) == [("a", 1, "x")]
    # Data without a manifest, as of a writer that died before the switch, is not seen, and the version can be made again.
    batch(spark, [("z", 0, "lost", 0)]).drop("seq").write.parquet(f"{table.path}/data/2-dead/bucket=0")
    assert rows(table.read()) == [("a", 1, "x")]
    table.upsert(batch(spark, [("b", 2, "y", 1)]), "seq")
    assert rows(table.read()) == [("a", 1, "x"), ("b", 2, "y")]


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=4)
    other = KeyedTable(spark, table.path)
    seen = other.manifest()
    table.upsert(batch(spark, [("a", 1, "x", 1)]), "seq")
    monkeypatch.setattr(other, "manifest", lambda version=None: seen)
    with pytest.raises(ConcurrentChange):
        other.upsert(batch(spark, [("b", 1, "late", 1)]), "seq")
    assert rows(table.read()) == [("a", 1, "x")]


def test_empty_upsert_and_vacuum(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=2)
    for i in range(5):
        table.upsert(batch(spark, [("a", i, "x", 1), ("b", i, "x", 1), ("c", i, "x", 1), ("d", i, "x", 1)]), "seq")
    assert table.upsert(batch(spark, []), "seq").buckets == 0
    assert table.vacuum(keep=2) and rows(table.read()) == [(k, 4, "x") for k in "abcd"]
    assert {f.split("/data/")[1][:2] for f in files(table.path)} == {"5-"}

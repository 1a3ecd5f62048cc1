"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, rows_of  # noqa: E402

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        assert mine
        return
    result = connect(sf_dir).execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert mine == rows_of(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["smtp_command", "n"]

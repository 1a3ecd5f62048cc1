"""Merged distinct sketches against exact counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterscope.operators import distinct_sketches as ds


def rows(spark, first, last):
    """Values that recur on other days; nulls in both columns and in the time."""
    n = F.col("id")
    return spark.range(first, last).select(
        F.when(n % 11 != 0, F.timestamp_seconds(n % 5 * 86400)).alias("at"),
        F.when(n % 7 != 0, F.concat(F.lit("v"), (n % 40000).cast("string"))).alias("many"),
        F.when(n % 3 == 0, (n % 4).cast("string")).alias("few"))


def estimates(sketches, days=None):
    return {r["column"]: r["estimate"] for r in ds.distinct_estimates(sketches, ["many", "few"], days).collect()}


def exact(df):
    return df.agg(F.countDistinct("many").alias("many"), F.countDistinct("few").alias("few")).first().asDict()


def near(found, true):
    assert found.keys() == true.keys()
    for name, n in true.items():
        assert abs(found[name] - n) <= ds.error_bound() * n, (name, found[name], n)


def test_merged_days_and_loads(spark):
    old, new = rows(spark, 0, 60_000), rows(spark, 50_000, 90_000)
    both = old.union(new)
    stored = ds.merge_sketches([ds.daily_sketches(x, "at", ["many", "few"]) for x in (old, new)], ["many", "few"])
    assert stored.count() == 6  # five days and rows without a time
    near(estimates(stored), exact(both))
    near(estimates(stored, F.col("day") >= F.lit("1970-01-03")), exact(both.filter("at >= timestamp'1970-01-03'")))
    near(estimates(stored, F.col("day").isNull()), exact(both.filter("at is null")))


def test_nothing_to_count(spark):
    empty = ds.daily_sketches(rows(spark, 0, 0), "at", ["many", "few"])
    assert empty.count() == 0
    assert estimates(empty) == {"many": 0, "few": 0}
    nulls = spark.range(3).selectExpr("timestamp_seconds(id) AS at", "CAST(NULL AS STRING) AS many", "CAST(NULL AS STRING) AS few")
    assert estimates(ds.daily_sketches(nulls, "at", ["many", "few"])) == {"many": 0, "few": 0}

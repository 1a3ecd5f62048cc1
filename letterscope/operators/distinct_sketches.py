"""Distinct counts that can be stored by day and merged.

An exact distinct count has to see all rows again when a day is added.  A
sketch of fixed size per day and column is stored instead; counts over any
range of days merge the sketches.  Exact counts stay in :mod:`reports`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 ** PRECISION registers; the relative standard error is about 1.04 / sqrt(registers).
PRECISION = 14


def error_bound(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """Share of the true count by which an estimate may be off, at that many standard errors."""
    return deviations * 1.04 / 2 ** (precision / 2)


def daily_sketches(df: DataFrame, time: str, columns: list[str], precision: int = PRECISION) -> DataFrame:
    """``day`` and one sketch for each of ``columns``, which must be strings, integers or binary.

    Nulls are not counted.  Rows without a time make up the null day, so that no
    value is lost.  An empty table gives no rows.  Sketches are built on every
    task before the shuffle, so a hot day moves as one row for each task.
    """
    day = F.to_date(F.col(time)).alias("day")
    return df.groupBy(day).agg(*[F.hll_sketch_agg(c, precision).alias(c) for c in columns])


def merge_sketches(tables: list[DataFrame], columns: list[str]) -> DataFrame:
    """One row for each day of any of ``tables``; the sketches of a day that occurs repeatedly are merged."""
    every = reduce(DataFrame.unionByName, [t.select("day", *columns) for t in tables])
    return every.groupBy("day").agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def distinct_estimates(sketches: DataFrame, columns: list[str], days: Column | None = None) -> DataFrame:
    """One row ``column, estimate`` for each of ``columns``, over all days or those for which ``days`` holds.

    Without any day the estimates are 0.
    """
    chosen = sketches if days is None else sketches.filter(days)
    merged = chosen.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns])
    return merged.unpivot([], columns, "column", "estimate")

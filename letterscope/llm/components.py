"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterscope.llm.common import Staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step.

    Minima are aggregated with partial sums on every task and joined back, so
    the neighbours of a hot node never meet in one task.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
    return (
        large.join(lowest, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .union(lowest.select("hi", F.col("m").alias("lo")))
        .distinct()
    )


def components(edges: DataFrame, left: str, right: str) -> Staged:
    """(node, root) of every node that has an edge to another one.

    ``root`` is the smallest node of the component.  Nodes may be of any type
    that has an order.  Each round is written to the shared folder; an empty
    edge table gives an empty result.
    """
    current = Staged(
        edges.filter(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")).distinct(), "edges")
    before = _state(current.df)
    while before[0]:
        after = Staged(_round(current.df), "edges")
        current.drop()
        current, now = after, _state(after.df)
        if now == before:
            break
        before = now
    out = Staged(
        current.df.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        .union(current.df.select("lo", "lo").distinct()), "components")
    current.drop()
    return out

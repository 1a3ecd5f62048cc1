"""Mixing sources to target weights by repeating and thinning whole documents.

Sizes are summed for each source, a target follows from the weights, and the
repetition rate is target over size.  Every document is taken floor(rate)
times, and once more if a number drawn from its id's hash is below the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, BUDGET_PERCENT, MOST = (5, 2, 1), 150, 2


def size_of(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = BUDGET_PERCENT, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from one row for each source (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``percent`` of all sizes.  A target stops at ``most`` times its source's
    size, and what it leaves goes to the others by weight.  In the order of
    size over weight the stopped sources come first, so one running sum finds
    them: a source is stopped if its limit is below its share of what the ones
    before it leave.  One row for each source is sorted here, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
    limit = F.col("source_size") * most
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) * F.lit(percent / 100) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    share = left / F.sum("weight").over(after)  # for each unit of weight, if no further source stops
    shared = weighed.withColumns({"limit": limit.cast("double"), "share": share})
    # From the first source that does not stop, all get its share for each unit of weight.
    shared = shared.withColumn("place", F.row_number().over(order))
    goes_on = F.when(F.col("limit") >= F.col("share") * F.col("weight"), F.struct("place", "share"))
    shared = shared.withColumn("level", F.min(goes_on).over(everything)["share"])
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return shared.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies_of(doc_id: Column | str, rate: Column, seed: int) -> Column:
    """floor(rate), and one more with probability rate - floor(rate), by hash of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    drawn = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    whole = F.floor(rate)
    return (whole + F.when(drawn < rate - whole, F.lit(1)).otherwise(F.lit(0))).cast("long")


def mixed(docs: DataFrame, seed: int = 17, **shares) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken; other columns unchanged.

    A null text has size 0; a null source is a source of its own, last in
    order.  A source of size 0 has rate 0.  Repeated rows draw alike, as the
    draw depends on the id and the seed only.  An empty table gives no rows.
    """
    own = docs.select(F.struct("*").alias("__row"), F.col("doc_id"), F.col("source"), size_of().alias("size"))
    sizes = docs.select("source", size_of().alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, **shares).withColumnRenamed("source", "__source")
    return (
        own.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
        .withColumn("copies", copies_of("doc_id", F.col("rate"), seed))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mix_sources(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row of ``docs``."""
    narrow = docs.select("doc_id", "source", "text")
    return mixed(narrow, seed).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixture(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken, columns unchanged."""
    taken = mixed(docs, seed).filter("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).select("__row.*")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)] AS weight, source_size * 2 AS cap FROM sources
), shared AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share,
            row_number() OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST) AS place
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
  SELECT *, (SELECT share FROM shared WHERE cap >= share * weight ORDER BY place LIMIT 1) AS level FROM shared
), planned AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target FROM levelled
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), drawn AS (
  SELECT *, floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM rated
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM drawn
"""

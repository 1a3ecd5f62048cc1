"""Dense row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letterscope.staging import stage


def with_ordinal(df: DataFrame, *order: str, name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``order`` (a unique key).

    Rows are range-partitioned and sorted, written once, and each partition's
    start is the row count of the partitions before it.  The table of starts
    has one row per partition, so it is small however large the data is.  A
    unique key means no partition can be dominated by one value.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__row", 33))
        .withColumn("__row", F.col("__row").bitwiseAND((1 << 33) - 1))
    )
    kept = stage(placed, "ordinal")
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy("__part").agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    )
    return kept.join(F.broadcast(starts), "__part").select(
        *df.columns, (F.col("__start") + F.col("__row")).alias(name)
    )


def positional_pairs(left: DataFrame, left_key: str, right: DataFrame, *right_keys: str) -> DataFrame:
    """``left_key`` of left row *i* with ``right_keys`` of right row *i*, null beyond the right side's end.

    Only key columns are read, numbered and moved; what belongs to the keys is
    joined on afterwards, each side's rows moving once.  Keys are unique.
    """
    numbered = with_ordinal(left.select(left_key), left_key)
    return positional_join(numbered, with_ordinal(right.select(*right_keys), *right_keys))


def positional_join(left: DataFrame, right: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Left row *i* with right row *i*; surplus right rows are dropped."""
    return left.join(right, ordinal, "left")


def document_id(ordinal: Column, style: str, email_hash: Column | None = None) -> Column:
    """Ids of the three tables: ``sequence`` (1-based), ``record`` and ``hash``."""
    if style == "sequence":
        return ordinal + 1
    if style == "record":
        return F.concat(F.lit("record_"), ordinal.cast("string"))
    if style == "hash":
        return F.coalesce(email_hash, F.concat(F.lit("email_"), ordinal.cast("string")))
    raise ValueError(f"unknown id style: {style}")

"""What several operators need: tables, staged results, bounded samples of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from letterscope.staging import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Staged:
    """A result written once to the shared folder; ``df`` reads it, ``drop`` deletes it.

    Later jobs read files that survive lost executors, and lineage ends here.
    """

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, label)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def labelled_ids(labels: DataFrame, column: str, per_class: int, seed: int = 1) -> DataFrame:
    """Up to ``per_class`` doc_ids of each value of ``column``, chosen by hash: (doc_id, label).

    One row for each labelled id; an id with contradicting labels keeps the
    larger one.  ``column`` has few different values.  Hashes beyond a limit
    that the first ``per_class`` of a class stay below are left out before rows
    move, so the ranking reads about ``per_class`` ids of each class.
    """
    ids = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id").agg(F.max(column).alias("label"))
    )
    # More than enough: ten standard deviations above ``per_class``.
    share = F.least(F.lit(1.0), F.lit(per_class + 10 * per_class**0.5 + 20) / F.count("*"))
    limits = ids.groupBy("label").agg((share * F.lit(2.0**64) - F.lit(2.0**63)).alias("__limit"))
    by_hash = Window.partitionBy("label").orderBy("__hash", "doc_id")
    return (
        ids.withColumn("__hash", F.xxhash64("doc_id", F.lit(seed))).join(F.broadcast(limits), "label")
        .filter(F.col("__hash").cast("double") <= F.col("__limit"))
        .withColumn("__rank", F.row_number().over(by_hash))
        .filter(F.col("__rank") <= per_class)
        .select("doc_id", "label")
    )


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str, per_class: int, *columns: Column | str) -> DataFrame:
    """One document of each sampled id with its label: of repeated ids the row with the least hash.

    The sample has at most ``per_class`` ids of each class, 16 bytes each, so
    broadcasting it is bounded by a parameter.  Every task cuts its rows to one
    for each id before they move.
    """
    sample = labelled_ids(labels, column, per_class)
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "label", F.struct(*columns).alias("__row"))
    least = F.min(F.struct(F.xxhash64("__row").alias("hash"), F.col("__row").alias("row"))).alias("__least")
    return rows.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "__least.row.*")

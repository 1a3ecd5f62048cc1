"""A training corpus from raw documents, in five stages.

Quality rules throw documents out, near duplicates go, secrets are blanked out,
sources are mixed to their weights, and the rest is packed into sequences.
Every stage's result is written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterscope.llm import mixing, near_dedup, packing, quality_rules, secrets
from letterscope.llm.common import Staged, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules keep.  The rules learn from ``docs`` and the labels table."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.first_of_groups(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by their kind."""
    return secrets.without_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a copy is a row of its own with the same id."""
    return mixing.mixture(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", good_documents),
    ("near duplicates", one_of_each),
    ("secrets", without_secrets),
    ("mixing", mixture),
    ("packing", sequences),
]

# Learned rules and tokenization have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return STAGES[-1][1](spark, docs, sf_dir)

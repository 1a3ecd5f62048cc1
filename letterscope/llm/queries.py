"""The named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from letterscope.llm import (
    alignment,
    conversations,
    language_id,
    mixing,
    near_dedup,
    packing,
    phrases,
    quality_rules,
    resampling,
    secrets,
    token_counts,
    toxicity,
    vector_dedup,
)
from letterscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprint(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_toxicity, op2_secrets, op3_mixing, op4_near_duplicates, op5_near_vectors, op6_language,
              op7_resampling, op8_packing, op9_token_counts, op10_quality_rules, op11_conversations,
              op12_fingerprints, op13_alignment)
}

# All documents linked by word shingles, and all vectors by cosine, in plain SQL.
NEAR_DOCUMENTS = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), gathered AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM worded
), members AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS m FROM gathered
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM gathered
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, min(r.y) AS component_id, g.doc_id = min(r.y) AS kept
FROM gathered g JOIN reached r ON g.doc_id = r.x GROUP BY g.doc_id, g.s
"""

NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0 AND len([v FOR v IN embedding IF v <> 0]) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), smallest AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
), counted AS (
  SELECT x, count(*)::BIGINT AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest s ON vec_id = s.x LEFT JOIN counted c ON vec_id = c.x
"""

ORACLE = {"op3_mixing": mixing.ORACLE, "op4_near_duplicates": NEAR_DOCUMENTS, "op5_near_vectors": NEAR_VECTORS}

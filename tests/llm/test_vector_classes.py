"""Vectors whose ids repeat, and recall of the tables at every width."""

from __future__ import annotations

import numpy as np
import pytest

from letterscope.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<double>, label int"


def result(spark, rows):
    found = vector_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found)


def test_ids_shared_by_two_classes(spark):
    """Two pairs of near vectors, far from each other, with one id in both; the same id under another label."""
    rng = np.random.Generator(np.random.PCG64(7))
    a, b = rng.normal(size=(2, 64))
    rows = [(1, a, 0), (2, a + 0.01 * rng.normal(size=64), 0), (1, b, 0), (3, b + 0.01 * rng.normal(size=64), 0), (1, a, 5)]
    rows = [(i, v.tolist(), label) for i, v, label in rows]
    assert result(spark, rows) == [
        (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_component_takes_the_smallest_id_of_its_classes(spark):
    """Links run over classes in any order of names; repeated rows count as links."""
    rng = np.random.Generator(np.random.PCG64(8))
    a = rng.normal(size=32)
    near = [a + 0.01 * rng.normal(size=32) for _ in range(3)]
    rows = [(9, near[0].tolist(), 0), (4, near[1].tolist(), 0), (7, near[2].tolist(), 0), (6, near[2].tolist(), 0)]
    assert result(spark, rows) == [(4, 3, 4, True), (6, 3, 4, False), (7, 3, 4, False), (9, 3, 4, False)]


@pytest.mark.parametrize("width", [8, 16, 24, 32, 64])
def test_tables_meet_pairs_at_the_threshold(width):
    """Share of pairs with a cosine of 0.93 to 0.935 that agree in a table."""
    rng = np.random.Generator(np.random.PCG64(width))
    x = rng.normal(size=(4000, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= np.einsum("ij,ij->i", side, x)[:, None] * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.935, len(x))[:, None]
    y = cosine * x + np.sqrt(1 - cosine**2) * side
    tables = vector_dedup.Tables(x)
    bits, keys = tables.codes(x)
    others, theirs = tables.codes(y)
    assert keys.shape[1] >= vector_dedup.TABLES
    met = (keys == theirs).any(axis=1)
    near = np.bitwise_count(bits ^ others).sum(axis=1) <= vector_dedup.FAR_SHARE * bits.shape[1] * 8
    assert (met & near).mean() >= 0.98

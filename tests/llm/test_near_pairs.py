"""Which pairs of near-duplicate candidates reach the full sets."""

import numpy as np

from letterscope.llm import near_dedup


def test_texts_just_below_the_threshold_are_told_apart_by_sketches(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for j in rng.choice(300, 8, replace=False):  # pairs have about 70 to 80 % in common
            words[j] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    rows += [(100, rows[0][1] + " more"), (101, "more " + rows[1][1])]
    compared = []
    confirmed = near_dedup.NearDuplicates._confirmed

    def counted(self, pairs, sets):
        compared.append(pairs.count())
        return confirmed(self, pairs, sets)

    monkeypatch.setattr(near_dedup.NearDuplicates, "_confirmed", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, width=3, percent=85).collect()}
    shingles = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, w in ((i, t.split()) for i, t in rows)}
    linked = {(a, b) for a in shingles for b in shingles if a < b and 100 * len(shingles[a] & shingles[b]) >= 85 * len(shingles[a] | shingles[b])}
    assert linked == {(0, 100), (1, 101)} and found == {i: {100: 0, 101: 1}.get(i, i) for i in found}
    assert 2 <= sum(compared) <= 20  # out of 1,891 pairs


def test_whole_sketches_differ_in_no_more_bits_than_sets_in_members():
    rng = np.random.default_rng(6)
    for n, other in ((40, 3), (400, 60), (4000, 900)):
        common = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        sets = [np.unique(np.append(common, rng.integers(0, 2**63, other, dtype=np.uint64))) for _ in range(2)]
        a, b = near_dedup.sketches(np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets])))
        differing = int(np.bitwise_count(a ^ b).sum())
        assert 0 < differing <= len(np.setxor1d(*sets))


def test_long_texts_are_linked(spark):
    long = [f"w{i}" for i in range(near_dedup.WHOLE + 3)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-20])), (3, " ".join(long[2:])), (4, " ".join(reversed(long)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(docs, width=3, percent=85).collect())
    assert found == [(1, 1), (2, 1), (3, 1), (4, 4)]

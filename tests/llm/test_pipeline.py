"""The pipeline's stages on the smallest documents, each held against its input."""

import collections

import corpus_pipeline
from letterscope.llm.common import Staged, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        docs = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
        after = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        assert docs.columns == names and set(after) <= set(before)
        if name == "secrets":
            assert after == before and docs.filter("text rlike 'AKIA[A-Z0-9]{16,}'").isEmpty()
        elif name != "mixing":
            assert all(n <= before[i] for i, n in after.items())
        else:
            assert max(after.values()) <= 2
        counts.append(sum(after.values()))
    assert counts[0] < 200 and counts[1] <= counts[0] and counts[2] == counts[1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    totals = pieces.groupBy("doc_id").sum("length").collect()
    assert len(totals) == docs.select("doc_id").distinct().count()

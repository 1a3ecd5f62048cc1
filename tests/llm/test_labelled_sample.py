"""The sample that models learn from has one row for each id, and texts stay on the executors."""

from pyspark.sql import functions as F

from letterscope.llm import language_id
from letterscope.llm.common import labelled_rows


def test_repeated_ids_count_once(spark):
    docs = spark.range(3000).select((F.col("id") % 10).alias("doc_id"), F.format_string("text %d", F.col("id") % 70).alias("text"))
    labels = spark.range(10).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    docs = docs.union(docs.filter("doc_id = 3").withColumn("text", F.lit(None).cast("string")))
    first = labelled_rows(docs, labels, "quality", 4, "text").collect()
    assert len(first) == len({r.doc_id for r in first}) == 8
    assert sorted(first) == sorted(labelled_rows(docs.repartition(7), labels, "quality", 4, "text").collect())


def test_language_sample_leaves_executors_as_vectors(spark, monkeypatch):
    seen = {}

    class Seen(language_id.Model):
        def __init__(self, x, languages):
            seen.update(x=x.copy(), languages=languages)

    monkeypatch.setattr(language_id, "Model", Seen)
    texts = ["the cat sat on the mat", "le chat est sur la table", "der Hund"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    language_id.train(docs)
    assert sorted(map(tuple, seen["x"].tolist())) == sorted(map(tuple, language_id.frequencies(texts).tolist()))

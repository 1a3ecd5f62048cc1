"""What is learned or kept covers every row, however many or often repeated."""

from pyspark.sql import functions as F

from letterscope.llm import resampling


def test_target_model_counts_all_good_documents(spark):
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.format_string("a%d b%d", F.col("id") % 300, F.col("id") % 7).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert resampling.resample(docs, labels).filter("log_ratio <> 0").count() == 0
    nulls = docs.union(spark.createDataFrame([(None, "zz yy")], "doc_id long, text string")).coalesce(4)
    rows = resampling.resample(nulls, labels.union(spark.createDataFrame([(None, 1)], "doc_id long, quality int")))
    assert rows.filter("doc_id is null and log_ratio < 0").count() == 1 and rows.count() == 20_501

"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# MIME messages travel through Arrow in batches of rows; a message can be tens
# of megabytes, so a batch must stay small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # Above 8000 bytes the JVM does not compile a method; wide projections run
    # faster as many small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "letterscope", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session with the package settings; ``extra`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark

"""Nested documents, per-row load checks and last-write-wins tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from letterscope.functions.dates import strict_date
from letterscope.functions.html import resolve_body
from letterscope.functions.net import is_ip, is_private
from letterscope.schemas import struct


def final_documents(joined: DataFrame, *keys: str) -> DataFrame:
    """Messages with their frames as nested documents.

    Correlation members are placeholders: nothing is correlated.
    """
    def peer(side: str) -> Column:
        return F.struct(
            F.col(f"{side}_ip").alias("ip"), F.col(f"{side}_port").alias("port"),
            is_private(f"{side}_ip").alias("is_private"),
        )

    smtp = F.struct(
        F.col("smtp_command_line").alias("command_line"), F.col("smtp_req_command").alias("req_command"),
        F.col("smtp_req_parameter").alias("req_parameter"),
        F.col("smtp_response_code").alias("response_code"), F.col("smtp_response").alias("response"),
        "is_starttls", "tcp_len", "frame_len", "tls_record_content_type",
    )
    false = F.lit(False)
    return joined.select(
        *keys,
        F.col("date").alias("timestamp"),
        F.struct("from", "to", "cc", "bcc").alias("email"),
        F.struct(
            "message_id", "subject", F.lit("multipart").alias("content_type"),
            resolve_body("body_text", "body_html").alias("body_text"), "body_html",
        ).alias("message"),
        F.struct("protocol", peer("src").alias("source"), peer("dst").alias("destination")).alias("network"),
        smtp.alias("smtp"),
        "attachments",
        F.struct(
            F.struct(false.alias("matched")).alias("cgnat"),
            F.struct(false.alias("session_found")).alias("radius"),
        ).alias("correlation"),
    )


def check_documents(documents: DataFrame, date: str | None, *ips: str) -> DataFrame:
    """Add ``accepted`` and ``reason``: the first typed field a row fails, if any."""
    def bad_ip(name: str) -> Column:
        return F.coalesce(~is_ip(name), F.lit(False))

    failures = [F.when(bad_ip(name), F.lit(f"bad ip: {name}")) for name in ips]
    if date:
        bad_date = F.col(date).isNotNull() & strict_date(date).isNull()
        failures.insert(0, F.when(bad_date, F.lit(f"bad date: {date}")))
    checked = documents.withColumn("reason", F.coalesce(*failures))
    return checked.withColumn("accepted", F.col("reason").isNull())


def last_write(documents: DataFrame, key: str, *sequence: str) -> DataFrame:
    """One row per key, the latest.  Spark cuts each task to one row per key before the shuffle."""
    newest = Window.partitionBy(key).orderBy(*[F.desc(s) for s in sequence])
    return documents.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def upsert(existing: DataFrame, new: DataFrame, key: str, *sequence: str) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those with the same key."""
    latest = last_write(new, key, *sequence)
    return existing.join(latest.select(key), key, "left_anti").unionByName(latest)


def conform(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Columns of the declared schema, cast, in its order."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in struct(schema)])


def replace_table(df: DataFrame, schema: str | StructType, path: str, partition_by: list[str] | None = None) -> None:
    """Create or replace a parquet table with a declared schema; old data is dropped."""
    writer = conform(df, schema).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def bulk_pairs(documents: DataFrame, table: str, doc_id: str = "_id") -> DataFrame:
    """Action and document JSON of every row; null members are left out."""
    fields = [c for c in documents.columns if c != doc_id]
    action = F.struct(F.struct(F.lit(table).alias("_index"), F.col(doc_id).alias("_id")).alias("index"))
    return documents.select(
        F.to_json(action).alias("action"), F.to_json(F.struct(*[f"`{c}`" for c in fields])).alias("document")
    )


def write_bulk_file(pairs: DataFrame, path: str) -> None:
    """One value of two lines per document, so the lines of a pair stay together."""
    pairs.select(F.concat_ws("\n", "action", "document").alias("value")).write.text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON, one document per line."""
    df.write.json(path)


def attachment_report(content: DataFrame) -> DataFrame:
    """Six report columns; attachment names are joined with ``', '``."""
    names = F.transform(
        F.coalesce("attachments", F.array()),
        lambda a: F.coalesce(a["filename"], F.lit("unknown")),
    )
    return content.select(
        F.col("file_id").alias("File ID"), F.col("filename").alias("Filename"),
        F.coalesce("metadata.from", F.lit("N/A")).alias("From"),
        F.coalesce("metadata.subject", F.lit("N/A")).alias("Subject"),
        F.coalesce(F.size("attachments"), F.lit(0)).alias("Attachment Count"),
        F.array_join(names, ", ").alias("Attachment Names"),
    )


def write_report(report: DataFrame, path: str) -> None:
    report.write.option("header", True).option("escape", '"').csv(path)

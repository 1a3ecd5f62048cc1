"""Loads that take good rows, keep the bad ones apart with a reason, and tell how it went.

One job writes all rows, split by whether they pass, and counts the outcomes on
the way.  Rejected rows are stored whole, so they can be mended and loaded again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from letterscope.functions.dates import mail_date, strict_date
from letterscope.functions.net import is_ip
from letterscope.operators.loading import final_documents
from letterscope.operators.mime import email_hash, enrich
from letterscope.operators.ordinals import document_id

# Fixed value: the longest exact-match value, in bytes, that the tables take.
LONGEST_KEYWORD = 32766


def bad_date(name: str) -> dict[str, Column]:
    return {f"bad date: {name}": F.col(name).isNotNull() & strict_date(name).isNull()}


def bad_ips(*names: str) -> dict[str, Column]:
    return {f"bad ip: {name}": ~is_ip(name) for name in names}


def too_long(*names: str) -> dict[str, Column]:
    return {f"too long: {name}": F.octet_length(F.col(name)) > LONGEST_KEYWORD for name in names}


@dataclass(frozen=True)
class Loaded:
    """What a load did: where its rows are, how many passed, and how many failed for which reason."""

    path: str
    schema: StructType
    accepted: int
    reasons: dict[str, int]

    @property
    def rejected(self) -> int:
        return sum(self.reasons.values())

    def rows(self, spark: SparkSession, accepted: bool | None = None) -> DataFrame:
        """Stored rows with ``accepted`` and ``reason``: those that passed, those that failed, or all."""
        stored = spark.read.schema(self.schema).parquet(self.path)
        return stored if accepted is None else stored.filter(F.col("accepted") == accepted)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """accepted, reason, n: one row for the accepted ones and one for each reason that occurred."""
        counted = [(True, None, self.accepted), *((False, r, n) for r, n in self.reasons.items())]
        return spark.createDataFrame([c for c in counted if c[2]], "accepted boolean, reason string, n bigint")

    def first_failures(self, spark: SparkSession, order: str, n: int = 5) -> DataFrame:
        """The first rejected rows by ``order``; only rejected rows are read."""
        return self.rows(spark, accepted=False).orderBy(order).limit(n)


def checked_load(documents: DataFrame, path: str, checks: dict[str, Column]) -> Loaded:
    """Write ``documents`` below ``path``; a row fails by the first check that holds (a null check does not hold)."""
    reason = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in checks.items()])
    # A reason decides in a column of its own, so that it is worked out once for a row.
    checked = documents.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())
    counted = Observation()
    counts = [F.count_if("accepted").alias("accepted")]
    counts += [F.count_if(F.col("reason") == name).alias(f"n{i}") for i, name in enumerate(checks)]
    checked.observe(counted, *counts).write.partitionBy("accepted").parquet(path)
    found = counted.get
    return Loaded(path, checked.schema, found["accepted"], {name: found[f"n{i}"] for i, name in enumerate(checks)})


def load_final_documents(joined: DataFrame, path: str, *keys: str) -> Loaded:
    """Messages with frames (``ordinal`` gives the place) as final documents: ``_id`` from 1, ``instant`` typed.

    Rejected: a timestamp in none of the accepted formats, an address that is none.
    """
    documents = final_documents(joined, *keys, "ordinal")
    typed = documents.select(
        document_id(F.col("ordinal"), "sequence").alias("_id"), strict_date("timestamp").alias("instant"),
        *[c for c in documents.columns if c != "ordinal"])
    checks = bad_date("timestamp") | bad_ips("network.source.ip", "network.destination.ip")
    return checked_load(typed, path, checks)


def content_documents(content: DataFrame, place: Column, parsed_at: Column | None = None) -> DataFrame:
    """Parsed messages in the form they are loaded in.

    ``_id`` is the record's hash, else ``email_<place>``; ``metadata.date`` is
    ISO text or null; flags, counts and the time are added.  Messages that did
    not parse have no document.
    """
    kept = content.filter("parse_error is null")
    hashed = kept if "email_hash" in content.columns else kept.withColumn("email_hash", email_hash())
    dated = hashed.withColumn("metadata", F.col("metadata").withField("date", mail_date("metadata.date")["iso"]))
    return enrich(dated, parsed_at).select(
        document_id(place, "hash", F.col("email_hash")).alias("_id"),
        *[c for c in dated.columns if c not in ("parse_error", "raw_body")],
        "has_attachments", "attachment_count", "body_length", "parsed_at")


def load_content_documents(content: DataFrame, path: str, place: Column, parsed_at: Column | None = None) -> Loaded:
    """Content documents, checked: exact-match fields may not be longer than the table takes, ids fit an integer."""
    documents = content_documents(content, place, parsed_at)
    checks = {"out of range: file_id": ~F.col("file_id").between(-(2**31), 2**31 - 1)} | too_long(
        "filename", "metadata.message_id", "metadata.from", "metadata.to", "metadata.subject",
        "metadata.content_type", "metadata.mime_version")
    return checked_load(documents, path, checks)


def load_traffic_documents(documents: DataFrame, path: str) -> Loaded:
    """Traffic documents, checked: both addresses have to be addresses."""
    return checked_load(documents, path, bad_ips("source_ip", "destination_ip"))

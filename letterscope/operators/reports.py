"""Counts, top lists, timelines and load outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterscope.functions.text import bind

# Fixed values -------------------------------------------------------------
TOP = 10
# --------------------------------------------------------------------------
# Bucket widths an automatic timeline chooses from, in seconds (1 s ... 1 d).
WIDTHS = [1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400]


def value_counts(df: DataFrame, column: str, n: int | None = None, key: str | None = None) -> DataFrame:
    """Non-null values with their counts, most frequent first, ties by value."""
    name = key or column.strip("`").replace(".", "_")
    value = F.col(column)
    counts = df.filter(value.isNotNull()).groupBy(value.alias(name)).agg(F.count("*").alias("n"))
    ordered = counts.orderBy(F.desc("n"), name)
    return ordered.limit(n) if n else ordered


def traffic_summary(classified: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: frames, commands, response codes, encrypted frames, distinct values."""
    def distinct(c: str) -> Column:
        return F.approx_count_distinct(c) if approximate else F.countDistinct(c)

    return classified.agg(
        F.count("*").alias("total_records"),
        F.count("smtp_command").alias("with_command"),
        F.count("smtp_response_code").alias("with_response_code"),
        F.count_if("is_encrypted").alias("encrypted"),
        distinct("smtp_command").alias("distinct_commands"),
        distinct("ip_src").alias("distinct_sources"),
        distinct("ip_dst").alias("distinct_destinations"),
    )


def timeline(df: DataFrame, time: str, width_seconds: int) -> DataFrame:
    """Rows per time bucket; buckets with rows only."""
    bucket = F.window(time, f"{width_seconds} seconds")["start"]
    return (
        df.filter(F.col(time).isNotNull()).groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def choose_width(span_seconds: float, target: int) -> int:
    """Smallest listed width giving at most ``target`` buckets, else enough whole days."""
    for width in WIDTHS:
        if span_seconds / width + 1 <= target:
            return width
    day = WIDTHS[-1]
    return day * (int(span_seconds // (day * max(target - 1, 1))) + 1)


def auto_timeline(df: DataFrame, time: str, target: int = 50) -> DataFrame:
    """Timeline at an automatic width, empty buckets included.

    One pass finds the time span (two values reach the driver); the result has
    at most about ``target`` rows.
    """
    spark = df.sparkSession
    low, high = df.agg(
        F.min(F.unix_micros(time)).alias("low"), F.max(F.unix_micros(time)).alias("high")
    ).first()
    if low is None:
        return timeline(df, time, WIDTHS[0]).select("bucket", F.lit(0).alias("width_seconds"), "n")
    width = choose_width((high - low) / 1e6, target)
    step = width * 1_000_000
    first, last = low // step, high // step
    buckets = spark.range(first, last + 1, 1, 1).select(
        F.timestamp_micros(F.col("id") * step).alias("bucket")
    )
    return (
        buckets.join(timeline(df, time, width), "bucket", "left")
        .select("bucket", F.lit(width).alias("width_seconds"), F.coalesce("n", F.lit(0)).alias("n"))
    )


def discover(df: DataFrame, time: str, start: Column, end: Column, *tie: str, n: int | None = None) -> DataFrame:
    """Rows of a time range, newest first; with ``n``, only the first so many."""
    # The optimizer puts the expression of a worked-out time in place of its name, as often as it is named.
    found = df.filter(bind(F.col(time), lambda t: t.between(start, end))).orderBy(F.desc(time), *tie)
    return found if n is None else found.limit(n)


def has_attachments(attachments: Column | str) -> Column:
    return F.coalesce(F.size(attachments), F.lit(0)) > 0


def attachment_totals(messages: DataFrame, attachments: str = "attachments") -> DataFrame:
    return messages.agg(
        F.count("*").alias("messages"),
        F.coalesce(F.sum(F.coalesce(F.size(attachments), F.lit(0))), F.lit(0)).alias("attachments"),
        F.count_if(has_attachments(attachments)).alias("messages_with_attachments"),
    )


def parse_outcomes(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("parse_error").isNull()).alias("successfully_parsed"),
        F.count_if(F.col("parse_error").isNotNull()).alias("failed"),
    )


def parse_summary(content: DataFrame) -> DataFrame:
    """One row of parse totals.

    Senders and recipients enter as counts; the lists themselves can grow with
    the data, so they are tables of their own (:func:`correspondents`).
    """
    blank = F.lit("")
    return content.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("parse_error").isNull()).alias("successfully_parsed"),
        F.count_if(F.col("parse_error").isNotNull()).alias("failed"),
        F.count_if(has_attachments("attachments")).alias("with_attachments"),
        F.coalesce(F.sum(F.coalesce(F.size("attachments"), F.lit(0))), F.lit(0)).alias("total_attachments"),
        F.countDistinct(F.nullif("metadata.from", blank)).alias("unique_senders"),
        F.countDistinct(F.nullif("metadata.to", blank)).alias("unique_recipients"),
    )


def write_summary(content: DataFrame, path: str, at: Column | None = None) -> None:
    """The parse summary as one JSON object below ``path``, with its time (now, unless given)."""
    time = F.current_timestamp() if at is None else at
    summary = parse_summary(content).select("*", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("parsing_time"))
    summary.coalesce(1).write.json(path)


def correspondents(content: DataFrame) -> DataFrame:
    """Distinct raw sender and recipient headers as rows: ``role, address``."""
    pairs = F.array(
        F.struct(F.lit("sender").alias("role"), F.col("metadata.from").alias("address")),
        F.struct(F.lit("recipient").alias("role"), F.col("metadata.to").alias("address")),
    )
    return (
        content.select(F.inline(pairs)).filter(F.coalesce("address", F.lit("")) != "").distinct()
    )


def attachment_ids(content: DataFrame) -> DataFrame:
    """Ids of messages with attachments, one row per message, sorted.

    Id 0 counts as "no id" here, as null does.
    """
    return (
        content.filter((F.col("file_id") != 0) & has_attachments("attachments"))
        .select("file_id", F.size("attachments").alias("attachments")).orderBy("file_id")
    )


def attachment_id_counts(content: DataFrame) -> DataFrame:
    listed = content.filter(F.col("file_id") != 0)
    return listed.agg(
        F.countDistinct("file_id").alias("unique_ids"),
        F.count_if(has_attachments("attachments")).alias("ids_with_attachments"),
    )


def flag_counts(content: DataFrame, order: str, n: int | None = None) -> DataFrame:
    """How often the flag is true or false; with ``n``, among the first so many files by name."""
    flag = F.col("has_attachments")
    files = content.select(order, flag)
    return (files if n is None else files.orderBy(order).limit(n)).agg(
        F.count_if(flag.eqNullSafe(True)).alias("flag_true"),
        F.count_if(flag.eqNullSafe(False)).alias("flag_false"),
        F.count("*").alias("checked"),
    )


def id_status(ids: DataFrame, content: DataFrame) -> DataFrame:
    """Each listed id with ``EXISTS`` or ``NOT FOUND`` among ids with attachments.

    The list filters the content first, so the last join carries no more ids
    than were asked for.
    """
    keys = ids.select("file_id").distinct()
    found = (
        content.filter(has_attachments("attachments") & (F.col("file_id") != 0))
        .select("file_id").join(keys, "file_id", "left_semi").distinct()
        .withColumn("found", F.lit(True))
    )
    return ids.join(found, "file_id", "left").select(
        "file_id", F.when(F.col("found"), F.lit("EXISTS")).otherwise(F.lit("NOT FOUND")).alias("status")
    )


def attachment_occurrence(content: DataFrame, message_key: str) -> DataFrame:
    """Per distinct attachment content: messages holding it and total bytes.

    Hash and message key are counted distinct in two steps, so one very common
    attachment spreads over many tasks.
    """
    items = content.select(F.col(message_key).alias("message"), F.inline("attachments")).filter(
        F.col("sha256").isNotNull()
    )
    per_message = items.groupBy("sha256", "message").agg(F.sum("size").alias("bytes"), F.count("*").alias("c"))
    return per_message.groupBy("sha256").agg(
        F.count("*").alias("messages"), F.sum("c").alias("copies"), F.sum("bytes").alias("total_bytes")
    )


def load_outcomes(checked: DataFrame) -> DataFrame:
    return checked.groupBy("accepted", "reason").agg(F.count("*").alias("n"))


def first_failures(checked: DataFrame, order: str, n: int = 5) -> DataFrame:
    return checked.filter(~F.col("accepted")).orderBy(order).limit(n)

"""The three end-to-end jobs, from sources to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterscope.operators.frames import classify_frames, clean_frames, frame_records, traffic_documents
from letterscope.operators.loading import final_documents
from letterscope.operators.mime import email_hash, enrich, parse_content, parse_messages
from letterscope.operators.ordinals import positional_pairs, with_ordinal
from letterscope.sources.documents import read_messages
from letterscope.sources.text_exports import numbered_lines, read_ragged_csv, split_export_line
from letterscope.staging import stage


def mail_documents(messages: DataFrame, frames: DataFrame, message_order: str, *frame_order: str) -> DataFrame:
    """Messages (``content`` plus a unique key) and frame records to final documents, by position.

    A message that does not parse has no position, so the next one takes its
    frame.  Messages are parsed once and stored; positions are worked out on
    keys alone.
    """
    parsed = stage(parse_messages(messages).filter("parse_error is null"), "parsed")
    pairs = positional_pairs(parsed, message_order, frames, *frame_order)
    framed = pairs.join(frames, list(frame_order), "left").drop(*frame_order)
    return final_documents(parsed.join(framed, message_order), message_order, "ordinal")


def mail_documents_from_files(spark: SparkSession, message_dir: str, export_path: str) -> DataFrame:
    lines = numbered_lines(spark, export_path)
    export = lines.select("file_name", "line_no", *split_export_line("value"))
    return mail_documents(
        read_messages(spark, message_dir), frame_records(export), "path", "file_name", "line_no"
    ).drop("ordinal")


def traffic_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ragged frame CSV to traffic documents."""
    return traffic_documents(classify_frames(clean_frames(read_ragged_csv(spark, path))))


def content_from_files(spark: SparkSession, path: str, pattern: str = "*.eml") -> DataFrame:
    """Message files to content records with hash and counts.

    Parse once and store the result; a table answers later questions without
    touching the messages again.
    """
    files = with_ordinal(
        read_messages(spark, path, pattern, min_bytes=0).select("path", "filename", "file_size"),
        "filename", "path", name="file_id",
    )
    bodies = read_messages(spark, path, pattern, min_bytes=0).select("path", "content")
    content = parse_content(bodies.join(files, "path"))
    return enrich(content.filter("parse_error is null").withColumn("email_hash", email_hash())).drop("raw_body")

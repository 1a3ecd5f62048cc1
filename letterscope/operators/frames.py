"""Frame exports to frame records and to traffic documents.  Native columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterscope.functions import address, smtp
from letterscope.functions.text import clean_value, digit_int, epoch_ts, safe_int, to_double
from letterscope.schemas import TRAFFIC_DOCUMENT, struct


def undot(df: DataFrame) -> DataFrame:
    """Column names with ``_`` for ``.``."""
    return df.toDF(*[name.replace(".", "_") for name in df.columns])


def valid_frames(export: DataFrame) -> DataFrame:
    """Drop frames with under 5 fields, no time, source or destination, or an unreadable time."""
    time = to_double("`frame.time_epoch`")
    return export.filter(
        (F.col("n_fields") >= 5) & time.isNotNull()
        & F.col("`ip.src`").isNotNull() & F.col("`ip.dst`").isNotNull()
    )


def frame_records(export: DataFrame) -> DataFrame:
    """The 15-column frame record; columns beyond the export's own are kept."""
    known = {"frame.time_epoch", "ip.src", "tcp.srcport", "ip.dst", "tcp.dstport", "n_fields"}
    extra = [
        f"`{c}`" for c in export.columns
        if c not in known and not c.startswith(("smtp.", "tcp.", "frame.", "tls."))
    ]
    return valid_frames(export).select(
        *extra,
        to_double("`frame.time_epoch`").alias("timestamp"),
        F.col("`ip.src`").alias("src_ip"),
        safe_int("`tcp.srcport`").alias("src_port"),
        F.col("`ip.dst`").alias("dst_ip"),
        safe_int("`tcp.dstport`").alias("dst_port"),
        F.lit("SMTP").alias("protocol"),
        F.col("`smtp.command_line`").alias("smtp_command_line"),
        F.col("`smtp.req.command`").alias("smtp_req_command"),
        F.col("`smtp.req.parameter`").alias("smtp_req_parameter"),
        safe_int("`smtp.response.code`").alias("smtp_response_code"),
        F.col("`smtp.response`").alias("smtp_response"),
        safe_int("`tcp.len`").alias("tcp_len"),
        safe_int("`frame.len`").alias("frame_len"),
        F.col("`tls.record.content_type`").alias("tls_record_content_type"),
        smtp.is_starttls_frame("`smtp.req.command`", "`smtp.command_line`").alias("is_starttls"),
    )


def clean_frames(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Undotted columns with every text cell cleaned; ``keep`` names key columns left alone."""
    flat = undot(raw)
    return flat.select(*[c if c in keep else clean_value(c).alias(c) for c in flat.columns])


def classify_frames(clean: DataFrame) -> DataFrame:
    """Add time, command class, TLS flag, record type and addresses to cleaned frames."""
    encrypted = smtp.is_encrypted("smtp_req_command", "smtp_response", "tcp_dstport")
    return clean.select(
        "*",
        to_double("frame_time_epoch").alias("epoch"),
        epoch_ts(to_double("frame_time_epoch")).alias("timestamp"),
        smtp.smtp_command("smtp_req_command").alias("smtp_command"),
        encrypted.alias("is_encrypted"),
        smtp.record_type("smtp_req_command", "smtp_response_code").alias("record_type"),
        address.final_address("cflow_pie_ntop_smtp_mail_from", "smtp_req_parameter").alias("final_from"),
        address.final_address("cflow_pie_ntop_smtp_rcpt_to", "smtp_req_parameter").alias("final_to"),
    ).withColumn("encryption_status", smtp.encryption_status("is_encrypted"))


def loadable(classified: DataFrame) -> DataFrame:
    """Drop frames whose time is present but unreadable; a missing time is kept."""
    return classified.filter(F.col("frame_time_epoch").isNull() | F.col("epoch").isNotNull())


def traffic_documents(classified: DataFrame, *keys: str) -> DataFrame:
    """The 17-column traffic document, after optional key columns."""
    picked = {
        "frame_time_epoch": F.col("epoch"),
        "source_ip": F.col("ip_src"),
        "destination_ip": F.col("ip_dst"),
        "source_port": digit_int("tcp_srcport"),
        "destination_port": digit_int("tcp_dstport"),
        "smtp_parameter": F.col("smtp_req_parameter"),
        "response_code": digit_int("smtp_response_code"),
        "response_message": F.col("smtp_response"),
        "from_email": F.col("final_from"),
        "to_email": F.col("final_to"),
        "email_message": F.col("smtp_message"),
        "protocol": F.lit("SMTP"),
    }
    columns = [picked.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in struct(TRAFFIC_DOCUMENT)]
    return loadable(classified).select(*keys, *columns)


def starttls_frames(frames: DataFrame) -> DataFrame:
    """Frames whose split command reads ``STAR`` ``TLS``."""
    return frames.filter(smtp.is_starttls_short("`smtp.req.command`", "`smtp.req.parameter`"))


def tls_sessions(frames: DataFrame) -> DataFrame:
    """Distinct directional 4-tuples of STARTTLS frames."""
    return starttls_frames(frames).select(
        F.col("`ip.src`").alias("ip_src"), F.col("`ip.dst`").alias("ip_dst"),
        F.col("`tcp.srcport`").alias("tcp_srcport"), F.col("`tcp.dstport`").alias("tcp_dstport"),
    ).distinct()

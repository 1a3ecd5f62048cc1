"""Declared schemas of the engine's inputs and tables, as DDL text."""

from __future__ import annotations

from pyspark.sql.types import StructType


def struct(schema: str | StructType) -> StructType:
    """The type a DDL text names (reading DDL needs a running session)."""
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema

ATTACHMENT = (
    "struct<filename: string, content_type: string, size: bigint, "
    "content_disposition: string, md5: string, sha256: string>"
)

# Positional columns of the pipe-separated frame export.
FRAME_EXPORT_COLUMNS = [
    "frame.time_epoch", "ip.src", "tcp.srcport", "ip.dst", "tcp.dstport",
    "smtp.command_line", "smtp.req.command", "smtp.req.parameter",
    "smtp.response.code", "smtp.response", "tcp.len", "frame.len",
    "tls.record.content_type",
]

FRAME = (
    "timestamp double, src_ip string, src_port bigint, dst_ip string, dst_port bigint, "
    "protocol string, smtp_command_line string, smtp_req_command string, "
    "smtp_req_parameter string, smtp_response_code bigint, smtp_response string, "
    "tcp_len bigint, frame_len bigint, tls_record_content_type string, is_starttls boolean"
)

TRAFFIC_DOCUMENT = (
    "frame_time_epoch double, source_ip string, destination_ip string, source_port int, "
    "destination_port int, smtp_command string, smtp_parameter string, response_code int, "
    "response_message string, from_email string, to_email string, email_message string, "
    "is_encrypted boolean, encryption_status string, protocol string, record_type string, "
    "timestamp timestamp"
)

MESSAGE = (
    "message_id string, date string, `from` array<string>, `to` array<string>, "
    f"cc array<string>, bcc array<string>, subject string, body_text string, body_html string, "
    f"attachments array<{ATTACHMENT}>"
)

CONTENT = (
    "file_id bigint, filename string, file_size bigint, headers map<string,string>, "
    "body struct<text: string, html: string>, "
    "metadata struct<message_id: string, date: string, `from`: string, `to`: string, cc: string, "
    "bcc: string, subject: string, content_type: string, content_transfer_encoding: string, "
    "mime_version: string, received: array<string>>, "
    "attachments array<struct<filename: string, content_type: string, size: bigint, md5: string, "
    "sha256: string>>, email_hash string"
)

_PEER = "struct<ip: string, port: bigint, is_private: boolean>"
FINAL_DOCUMENT = (
    "timestamp string, "
    "email struct<`from`: array<string>, `to`: array<string>, cc: array<string>, bcc: array<string>>, "
    "message struct<message_id: string, subject: string, content_type: string, body_text: string, "
    "body_html: string>, "
    f"network struct<protocol: string, source: {_PEER}, destination: {_PEER}>, "
    "smtp struct<command_line: string, req_command: string, req_parameter: string, "
    "response_code: bigint, response: string, is_starttls: boolean, tcp_len: bigint, "
    "frame_len: bigint, tls_record_content_type: string>, "
    f"attachments array<{ATTACHMENT}>, "
    "correlation struct<cgnat: struct<matched: boolean>, radius: struct<session_found: boolean>>"
)

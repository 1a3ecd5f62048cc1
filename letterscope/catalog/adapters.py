"""Driver tables shown as mail inputs.

``events`` become SMTP frames, ``documents`` become messages.  The cell
expressions are plain SQL that Spark and DuckDB read alike; only the epoch of
a timestamp is spelled differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterscope.session import use_utc

# name -> SQL over events(event_id, us, user_id, event_type); ``us`` = epoch microseconds
FRAME_CELLS = {
    "frame.time_epoch": """CASE WHEN event_id % 101 = 0 THEN 'abc' WHEN event_id % 103 = 0 THEN ''
        ELSE concat(CAST(CAST(floor(us / 1000000) AS BIGINT) AS STRING), '.',
                    lpad(CAST(us % 1000000 AS STRING), 6, '0')) END""",
    "ip.src": """CASE user_id % 3 WHEN 0 THEN concat('10.0.0.', CAST(user_id % 250 AS STRING))
        WHEN 1 THEN concat('192.168.1.', CAST(user_id % 250 AS STRING))
        ELSE concat('8.8.4.', CAST(user_id % 250 AS STRING)) END""",
    "ip.dst": """CASE event_id % 7 WHEN 0 THEN '172.16.5.4' WHEN 1 THEN '999.1.1.1' WHEN 2 THEN ''
        WHEN 3 THEN '100.64.0.1' WHEN 4 THEN '192.0.0.9' WHEN 5 THEN '203.0.113.7' ELSE '9.9.9.9' END""",
    "tcp.srcport": """CASE WHEN event_id % 89 = 0 THEN 'x'
        ELSE CAST(1024 + event_id % 50000 AS STRING) END""",
    "tcp.dstport": """CASE event_id % 5 WHEN 0 THEN '25' WHEN 1 THEN '465' WHEN 2 THEN '587'
        WHEN 3 THEN '993' ELSE '2525' END""",
    "smtp.command_line": """CASE WHEN event_type = 'purchase' AND event_id % 4 = 1 THEN ' starttls now'
        WHEN event_type = 'click' THEN 'MAIL FROM' ELSE '' END""",
    "smtp.req.command": """CASE WHEN event_type = 'error' THEN ''
        WHEN event_id % 11 = 2 THEN ' N/A ' WHEN event_id % 11 = 4 THEN 'null'
        WHEN event_type = 'click' THEN CASE WHEN event_id % 11 = 3 THEN 'mail from' ELSE 'MAIL' END
        WHEN event_type = 'view' THEN ' RCPT '
        WHEN event_type = 'signup' THEN CASE WHEN event_id % 11 = 1 THEN '"EHLO"' ELSE 'EHLO' END
        WHEN event_id % 2 = 0 THEN 'starttls' ELSE 'STAR' END""",
    "smtp.req.parameter": """CASE event_type
        WHEN 'click' THEN CASE WHEN event_id % 11 = 5 THEN 'FROM:<root@localhost>'
            WHEN event_id % 11 = 6 THEN ''' <u@h> '''
            ELSE concat('FROM:<u', CAST(user_id AS STRING), '@example.com>') END
        WHEN 'view' THEN CASE WHEN event_id % 11 = 7 THEN 'to:<x@y>' ELSE 'TO:<root@localhost>' END
        WHEN 'signup' THEN 'client.example.net'
        WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'tls' ELSE 'TLS' END
        ELSE '' END""",
    "smtp.response.code": """CASE WHEN event_type <> 'error' THEN '' WHEN event_id % 4 = 0 THEN '250-'
        ELSE '550' END""",
    "smtp.response": """CASE WHEN event_type <> 'error' THEN ''
        WHEN event_id % 3 = 0 THEN '220 Ready to start TLS' ELSE '550 denied' END""",
    "tcp.len": "CAST(event_id % 1460 AS STRING)",
    "frame.len": "CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(66 + event_id % 1460 AS STRING) END",
    "tls.record.content_type": "CASE WHEN event_id % 17 = 0 THEN '22' ELSE '' END",
    "cflow.pie.ntop.smtp.mail_from": """CASE WHEN event_type = 'click' AND event_id % 2 = 0
        THEN concat('Sender <u', CAST(user_id AS STRING), '@corp.example.com>')
        WHEN event_id % 13 = 0 THEN ' x@y ' ELSE 'None' END""",
    "cflow.pie.ntop.smtp.rcpt_to": """CASE WHEN event_type = 'view' AND event_id % 2 = 0
        THEN concat('"r', CAST(user_id AS STRING), '@corp.example.org"')
        WHEN event_id % 19 = 0 THEN 'TO:<boss@localhost> TO:<z@q>' ELSE '' END""",
    "smtp.message": """CASE WHEN event_id % 6 = 0 THEN concat('note, with ', event_type, ', and more')
        WHEN event_id % 6 = 1 THEN 'NaN' ELSE '' END""",
}
EXPORT_CELLS = [
    "frame.time_epoch", "ip.src", "tcp.srcport", "ip.dst", "tcp.dstport", "smtp.command_line",
    "smtp.req.command", "smtp.req.parameter", "smtp.response.code", "smtp.response", "tcp.len",
    "frame.len", "tls.record.content_type",
]
CSV_CELLS = [
    "frame.time_epoch", "ip.src", "ip.dst", "tcp.srcport", "tcp.dstport", "smtp.req.command",
    "smtp.req.parameter", "smtp.response.code", "smtp.response", "cflow.pie.ntop.smtp.mail_from",
    "cflow.pie.ntop.smtp.rcpt_to", "smtp.message",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_frames(spark: SparkSession, sf_dir: str, cells: list[str] = CSV_CELLS) -> DataFrame:
    """``events`` as uncleaned frames, keyed by event_id.

    A row group of narrow rows holds millions of frames and is read by one
    task, so rows are spread evenly before cells are made and cleaned.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "unix_micros(CAST(ts AS TIMESTAMP)) AS us", "user_id", "event_type"
    ).repartition(spark.sparkContext.defaultParallelism)
    return events.selectExpr("event_id", *[f"{FRAME_CELLS[c]} AS `{c}`" for c in cells])


def export_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the cells of a pipe export: empty is null, 13 fields."""
    raw = raw_frames(spark, sf_dir, EXPORT_CELLS)
    cells = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in EXPORT_CELLS]
    return raw.select("event_id", *cells, F.lit(13).alias("n_fields"))


def frames_sql(cells: list[str] = CSV_CELLS) -> str:
    """DuckDB twin of :func:`raw_frames`, names undotted."""
    names = ",\n".join(f"{FRAME_CELLS[c]} AS {c.replace('.', '_')}" for c in cells)
    return f"""SELECT event_id, {names}
    FROM (SELECT event_id, epoch_us(ts) AS us, user_id, event_type FROM events)"""


_CRLF = "\r\n"
MESSAGE_SQL = {
    "from": "concat(source, '@', lang, '.example.com')",
    "to": "concat('reader', CAST(doc_id % 50 AS STRING), '@example.org')",
    "subject": "concat('Report ', CAST(doc_id AS STRING), ' from ', source)",
    "message_id": "concat('<', CAST(doc_id AS STRING), '@letters.example.org>')",
}


def message_text(docs: DataFrame) -> DataFrame:
    """Documents as RFC 822 text, in three shapes by ``doc_id % 3``.

    0: text and a named base64 attachment; 1: one text part; 2: HTML and an
    unnamed inline image.
    """
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    date = F.concat(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    b = F.concat(F.lit("=_part_"), F.col("doc_id").cast("string"))

    def lines(*items) -> F.Column:
        out = []
        for item in items:
            out += [F.lit(item) if isinstance(item, str) else item, F.lit(_CRLF)]
        return F.concat(*out)

    head = F.concat(*[
        F.concat(F.lit(label), F.expr(MESSAGE_SQL[key]), F.lit(_CRLF))
        for label, key in [("From: ", "from"), ("To: ", "to"), ("Subject: ", "subject"),
                           ("Message-ID: ", "message_id")]
    ], F.lit("Date: "), date, F.lit(_CRLF),
        F.when(F.col("doc_id") % 4 == 0, F.lit("Cc: copy@example.org" + _CRLF)).otherwise(F.lit("")),
        F.lit("Received: from a by b" + _CRLF + "Received: from b by c" + _CRLF + "MIME-Version: 1.0" + _CRLF))
    text8 = "Content-Type: text/{}; charset=utf-8" + _CRLF + "Content-Transfer-Encoding: 8bit" + _CRLF
    file = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt"))

    def opening(kind: str):
        return F.concat(F.lit(f'Content-Type: multipart/{kind}; boundary="'), b, F.lit('"'))

    edge, end = F.concat(F.lit("--"), b), F.concat(F.lit("--"), b, F.lit("--"))
    mixed = F.concat(head, lines(
        opening("mixed"), "", edge, text8.format("plain"), F.col("text"), edge,
        F.concat(F.lit('Content-Type: application/octet-stream; name="'), file, F.lit('"')),
        "Content-Transfer-Encoding: base64",
        F.concat(F.lit('Content-Disposition: attachment; filename="'), file, F.lit('"')),
        "", F.base64(F.encode("text", "UTF-8")), end,
    ))
    single = F.concat(head, F.lit(text8.format("plain") + _CRLF), F.col("text"))
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")),
                                  F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><body><p>"), escaped, F.lit("</p></body></html>"))
    related = F.concat(head, lines(
        opening("related"), "", edge, text8.format("html"), page, edge,
        "Content-Type: image/png", "Content-Transfer-Encoding: base64", "Content-Disposition: inline",
        "", F.base64(F.encode("source", "UTF-8")), end,
    ))
    shape = F.col("doc_id") % 3
    return docs.select("doc_id", F.when(shape == 0, mixed).when(shape == 1, single).otherwise(related).alias("text"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as message files: doc_id, path, filename, file_size, content.

    Parsing is the costly step, so rows are spread evenly before it.
    """
    raw = message_text(table(spark, sf_dir, "documents")).select("doc_id", F.encode("text", "UTF-8").alias("content"))
    name = F.concat(F.lit("msg-"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".eml"))
    return raw.repartition(spark.sparkContext.defaultParallelism).select(
        "doc_id", name.alias("path"), name.alias("filename"),
        F.octet_length("content").cast("bigint").alias("file_size"), "content",
    )


MESSAGES_SQL = f"""SELECT doc_id, text, source, {MESSAGE_SQL['from']} AS sender, {MESSAGE_SQL['to']} AS recipient,
    {MESSAGE_SQL['subject']} AS subject, {MESSAGE_SQL['message_id']} AS message_id,
    CASE WHEN doc_id % 4 = 0 THEN 'copy@example.org' ELSE '' END AS cc,
    strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000), '%a, %d %b %Y %H:%M:%S +0000') AS date,
    doc_id % 3 AS shape,
    concat('<html><body><p>', replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
           '</p></body></html>') AS page,
    concat('doc-', CAST(doc_id AS STRING), '.txt') AS file,
    concat('msg-', lpad(CAST(doc_id AS STRING), 12, '0'), '.eml') AS filename
    FROM documents"""

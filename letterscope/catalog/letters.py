"""Queries over messages, pages and dates, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterscope.catalog.adapters import MESSAGES_SQL, message_text, messages, table
from letterscope.catalog.traffic import EXPORT, RECORD_SQL, _VALID, _WS, _private, _valid4, records
from letterscope.functions import dates, html, search
from letterscope.functions.text import strip_or_null
from letterscope.operators import checked_load, loading, mail_search, mime, ordinals, reports
from letterscope.schemas import CONTENT, FINAL_DOCUMENT, MESSAGE
from letterscope.sources import documents as sources
from letterscope.staging import new_path, on_all_cores, single_files, stage

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return keep


M = f"m AS ({MESSAGES_SQL})"
_BODY = f"nullif(trim(text, {_WS}), '')"
_PAGE = f"nullif(trim(page, {_WS}), '')"


# --- text -----------------------------------------------------------------
@query("strip_body", f"SELECT doc_id, md5({_BODY}) AS body_md5 FROM documents")
def strip_body(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(strip_or_null("text").cast("binary")).alias("body_md5"))


@query("html_flag", """SELECT page_id, regexp_matches(html, '<[^>]+>') AS html_flag,
    regexp_matches(url, '<[^>]+>') AS url_flag FROM pages""")
def html_flag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", html.looks_like_html("html").alias("html_flag"), html.looks_like_html("url").alias("url_flag")
    )


def _text_sql(x: str) -> str:
    hidden = r"'<!--.*?-->|<!doctype[^>]*>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>'"
    bare = f"regexp_replace(regexp_replace({x}, {hidden}, '', 'gsi'), '<[^>]+>', '', 'g')"
    for entity, mark in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"),
                         ("&gt;", ">"), ("&amp;", "&")]:
        bare = f"replace({bare}, '{entity}', '{mark}')"
    return bare


@query("html_to_text", f"SELECT page_id, md5({_text_sql('html')}) AS text_md5 FROM pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(html.html_to_text("html").cast("binary")).alias("text_md5")
    )


@query("resolve_body", f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN md5({_text_sql('html')})
    WHEN 1 THEN md5({_text_sql('html')}) ELSE md5(url) END AS body_md5 FROM pages""")
def resolve_body(spark, sf_dir):
    """Pages as HTML in the text body, as HTML body only, and beside a plain text body."""
    case = F.col("page_id") % 3
    text = F.when(case == 0, F.col("html")).when(case == 2, F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(html.resolve_body(text, F.col("html")).cast("binary")).alias("body_md5")
    )


_STOP = "[" + ", ".join(f"'{w}'" for w in search.STOP_WORDS) + "]"
_TOKENS = rf"regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}]+)', 1)"
_ANALYZED = f"list_filter({_TOKENS}, lambda w: NOT list_contains({_STOP}, w))"


@query("analyze_text", f"""SELECT doc_id, len({_ANALYZED}) AS n_tokens,
    md5(array_to_string({_ANALYZED}, ' ')) AS tokens_md5 FROM documents""")
def analyze_text(spark, sf_dir):
    tokens = search.analyze("text")
    return table(spark, sf_dir, "documents").select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5")
    )


@query("search_any", f"""SELECT doc_id FROM documents
    WHERE list_has_any({_ANALYZED}, ['email', 'password', 'license'])""")
def search_any(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(search.matches_any("text", "Email, the PASSWORD or license")).select("doc_id")


@query("search_all", f"""SELECT conv_id, turn FROM (SELECT conv_id, turn, {_TOKENS} AS w FROM conversations)
    WHERE list_has_all(w, ['les', 'que'])""")
def search_all(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.filter(search.matches_all("text", "que LES")).select("conv_id", "turn")


@query("token_counts", f"""SELECT token, count(DISTINCT doc_id) AS documents, count(*) AS occurrences
    FROM (SELECT doc_id, unnest({_ANALYZED}) AS token FROM documents) GROUP BY 1""")
def token_counts(spark, sf_dir):
    tokens = search.token_table(table(spark, sf_dir, "documents"), "doc_id", "text")
    return tokens.groupBy("token").agg(
        F.count("*").alias("documents"), F.sum("occurrences").alias("occurrences")
    )


_RFC_DATE = """strftime(o_orderdate, '%a, ') || CAST(day(o_orderdate) AS VARCHAR) || strftime(o_orderdate, ' %b %Y')"""


@query("parse_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE
    epoch_us(o_orderdate) + 37272000000 - (CASE o_orderkey % 5 WHEN 0 THEN 5 WHEN 1 THEN -3.5 WHEN 2 THEN 0
        ELSE -8 END * 3600000000)::BIGINT END AS instant_us,
    CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT10:21:12') ||
        CASE o_orderkey % 5 WHEN 0 THEN '+05:00' WHEN 1 THEN '-03:30' WHEN 2 THEN '+00:00' ELSE '-08:00' END END
        AS iso,
    CASE WHEN o_orderkey % 5 IN (0, 1) AND day(o_orderdate) >= 10 THEN true
         ELSE false END AS strict FROM orders""")
def parse_dates(spark, sf_dir):
    """Order dates as mail dates: numeric zones, a comment, a zone name, and junk."""
    k = F.col("o_orderkey") % 5
    day = F.col("o_orderdate").cast("timestamp")
    zone = F.when(k == 0, "+0500").when(k == 1, "-0330").when(k == 2, "+0000 (UTC)").when(k == 3, "PST")
    text = F.when(k == 4, F.concat(F.lit("sometime "), F.date_format(day, "yyyy"))).otherwise(
        F.concat(F.date_format(day, "EEE, d MMM yyyy"), F.lit(" 10:21:12 "), zone)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("date"))
    parsed = orders.select("o_orderkey", dates.mail_date("date").alias("d"),
                           dates.strict_date("date").isNotNull().alias("strict"))
    return parsed.select("o_orderkey", F.unix_micros("d.instant").alias("instant_us"), "d.iso", "strict")


# --- messages, first form -------------------------------------------------
_FIRST = f"""doc_id, message_id, date, sender AS from_0, recipient AS to_0, cc AS cc_0, 0 AS n_bcc, subject,
    CASE WHEN shape < 2 THEN md5({_BODY}) END AS text_md5, CASE WHEN shape = 2 THEN md5({_PAGE}) END AS html_md5,
    CASE WHEN shape = 1 THEN 0 ELSE 1 END AS n_attachments,
    CASE shape WHEN 0 THEN file WHEN 2 THEN 'part-2.png' END AS name,
    CASE shape WHEN 0 THEN 'application/octet-stream' WHEN 2 THEN 'image/png' END AS kind,
    CASE shape WHEN 0 THEN 'attachment' WHEN 2 THEN 'inline' END AS disposition,
    CASE shape WHEN 0 THEN octet_length(encode(text)) WHEN 2 THEN octet_length(encode(source)) END AS size,
    CASE shape WHEN 0 THEN md5(text) WHEN 2 THEN md5(source) END AS md5,
    CASE shape WHEN 0 THEN sha256(text) WHEN 2 THEN sha256(source) END AS sha256"""


def first_form_view(df):
    att = F.get("attachments", F.lit(0))
    return df.select(
        "doc_id", "message_id", "date", F.array_join("from", "|").alias("from_0"),
        F.array_join("to", "|").alias("to_0"), F.array_join("cc", "|").alias("cc_0"),
        F.size("bcc").alias("n_bcc"), "subject", F.md5(F.col("body_text").cast("binary")).alias("text_md5"),
        F.md5(F.col("body_html").cast("binary")).alias("html_md5"), F.size("attachments").alias("n_attachments"),
        att["filename"].alias("name"), att["content_type"].alias("kind"),
        att["content_disposition"].alias("disposition"), att["size"].alias("size"),
        att["md5"].alias("md5"), att["sha256"].alias("sha256"),
    )


@query("parse_messages_a", f"WITH {M} SELECT {_FIRST} FROM m")
def parse_messages_a(spark, sf_dir):
    return first_form_view(mime.parse_messages(messages(spark, sf_dir)))


@query("attachment_hashes", f"""WITH {M} SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256,
    octet_length(encode(text)) AS size FROM m WHERE shape = 0""")
def attachment_hashes(spark, sf_dir):
    parsed = mime.parse_messages(messages(spark, sf_dir)).select("doc_id", F.inline("attachments"))
    return parsed.filter("content_disposition = 'attachment'").select("doc_id", "md5", "sha256", "size")


@query("fallback_names", f"""WITH {M} SELECT doc_id, 'part-2.png' AS name FROM m WHERE shape = 2""")
def fallback_names(spark, sf_dir):
    parsed = mime.parse_messages(messages(spark, sf_dir)).select("doc_id", F.inline("attachments"))
    return parsed.filter("content_disposition = 'inline'").select("doc_id", F.col("filename").alias("name"))


def message_files(spark, sf_dir):
    """Every message as a file of its own, written by all cores however few row groups the table has; the folders of the files."""
    return single_files(message_text(on_all_cores(table(spark, sf_dir, "documents"))).select("text"), "mail")


def _key(column):
    return F.regexp_extract(column, "^<([0-9]+)@", 1).cast("bigint").alias("doc_id")


@query("scan_messages", f"WITH {M} SELECT {_FIRST} FROM m")
def scan_messages(spark, sf_dir):
    read = sources.read_messages(spark, message_files(spark, sf_dir))
    parsed = mime.parse_messages(read)
    return first_form_view(parsed.withColumn("doc_id", _key("message_id")))


# --- messages, second form ------------------------------------------------
def content(spark, sf_dir, ids=None, **options):
    """Parsed messages; with ``ids`` only those files reach the parser."""
    mail = messages(spark, sf_dir).drop("path").withColumn("file_id", F.col("doc_id"))
    return mime.parse_content(mail if ids is None else mail.filter(F.col("doc_id").isin(ids)), **options)


_SECOND = """doc_id, filename, message_id, date, sender, recipient, cc, subject,
    CASE shape WHEN 0 THEN 'multipart/mixed' WHEN 1 THEN 'text/plain' ELSE 'multipart/related' END AS content_type,
    '1.0' AS mime_version, 2 AS n_received, 'from b by c' AS last_received,
    CASE WHEN shape < 2 THEN md5(text) END AS text_md5, CASE WHEN shape = 2 THEN md5(page) END AS html_md5,
    CASE WHEN shape = 0 THEN 1 ELSE 0 END AS n_attachments, CASE WHEN shape = 0 THEN file END AS name,
    CASE WHEN shape = 0 THEN octet_length(encode(text)) END AS size,
    CASE WHEN shape = 0 THEN md5(text) END AS md5, CASE WHEN shape = 0 THEN sha256(text) END AS sha256"""


@query("parse_messages_c", f"WITH {M} SELECT {_SECOND} FROM m")
def parse_messages_c(spark, sf_dir):
    att = F.get("attachments", F.lit(0))
    return content(spark, sf_dir).select(
        "doc_id", "filename", "metadata.message_id", "metadata.date", F.col("metadata.from").alias("sender"),
        F.col("metadata.to").alias("recipient"), "metadata.cc", "metadata.subject", "metadata.content_type",
        "metadata.mime_version", F.size("metadata.received").alias("n_received"),
        F.col("headers")["Received"].alias("last_received"),
        F.md5(F.col("body.text").cast("binary")).alias("text_md5"),
        F.md5(F.col("body.html").cast("binary")).alias("html_md5"),
        F.size("attachments").alias("n_attachments"), att["filename"].alias("name"), att["size"].alias("size"),
        att["md5"].alias("md5"), att["sha256"].alias("sha256"),
    )


@query("scan_eml", f"WITH {M} SELECT doc_id, subject, true AS file_size_known FROM m")
def scan_eml(spark, sf_dir):
    read = sources.read_messages(spark, message_files(spark, sf_dir), pattern="*.txt", min_bytes=0)
    parsed = mime.parse_content(read.withColumn("file_id", F.lit(1).cast("bigint")))
    return parsed.select(
        _key("metadata.message_id"), "metadata.subject", (F.col("file_size") > 50).alias("file_size_known")
    )


@query("rebase64", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def rebase64(spark, sf_dir):
    """Bodies that are base64 text without saying so, read with the second pass on."""
    docs = table(spark, sf_dir, "documents").repartition(spark.sparkContext.defaultParallelism)
    head = F.lit("From: a@example.com\r\nSubject: coded\r\n\r\n")
    mail = docs.select(
        "doc_id", F.col("doc_id").alias("file_id"), F.lit("x.eml").alias("filename"),
        F.col("n_chars").alias("file_size"),
        F.encode(F.concat(head, F.translate(F.base64(F.encode("text", "UTF-8")), "\r\n", "")), "UTF-8").alias("content"),
    )
    parsed = mime.parse_content(mail, base64_pass=True)
    return parsed.select("doc_id", F.md5(F.col("body.text").cast("binary")).alias("text_md5"))


def _ascii_sql(x: str) -> str:
    """JSON text of a string, everything but printable ASCII escaped."""
    code = "unicode(c)"
    return f"""('"' || array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: CASE
        WHEN c = '"' THEN '\\"' WHEN c = '\\' THEN '\\\\' WHEN {code} BETWEEN 32 AND 126 THEN c
        WHEN {code} = 8 THEN '\\b' WHEN {code} = 9 THEN '\\t' WHEN {code} = 10 THEN '\\n'
        WHEN {code} = 12 THEN '\\f' WHEN {code} = 13 THEN '\\r'
        WHEN {code} > 65535 THEN printf('\\u%04x\\u%04x', 55296 + (({code} - 65536) >> 10), 56320 + (({code} - 65536) & 1023))
        ELSE printf('\\u%04x', {code}) END), '') || '"')"""


_CRLF = "(chr(13) || chr(10))"
_HEADERS = [
    ("Cc", "cc", "doc_id % 4 = 0"), ("Content-Transfer-Encoding", "'8bit'", "shape = 1"),
    ("Content-Type", """CASE shape WHEN 0 THEN 'multipart/mixed; boundary="=_part_' || doc_id || '"'
        WHEN 1 THEN 'text/plain; charset="utf-8"' ELSE 'multipart/related; boundary="=_part_' || doc_id || '"' END""", "true"),
    ("Date", "date", "true"), ("From", "sender", "true"), ("MIME-Version", "'1.0'", "true"),
    ("Message-ID", "message_id", "true"), ("Received", "'from b by c'", "true"), ("Subject", "subject", "true"),
    ("To", "recipient", "true"),
]
_HEADERS_JSON = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {given} THEN '\"{name}\": ' || {_ascii_sql(value)} END" for name, value, given in _HEADERS) + ")"
_METADATA = {
    "bcc": "''", "cc": "cc", "content_transfer_encoding": "CASE WHEN shape = 1 THEN '8bit' ELSE '' END",
    "content_type": "CASE shape WHEN 0 THEN 'multipart/mixed' WHEN 1 THEN 'text/plain' ELSE 'multipart/related' END",
    "date": "date", "from": "sender", "message_id": "message_id", "mime_version": "'1.0'", "received": None,
    "subject": "subject", "to": "recipient",
}
_METADATA_JSON = " || ', ' || ".join(
    f"'\"{name}\": ' || " + (_ascii_sql(value) if value else "'[\"from a by b\", \"from b by c\"]'") for name, value in _METADATA.items())
_RECORD_JSON = f"""'{{"attachments": [' || CASE WHEN shape = 0 THEN '{{"content_type": "application/octet-stream", "filename": "' || file
    || CASE WHEN text = '' THEN '' ELSE '", "md5": "' || md5(text) || '", "sha256": "' || sha256(text) END
    || '", "size": ' || strlen(text) || '}}' ELSE '' END || '], "body": {{'
    || CASE WHEN shape = 2 THEN '"html": ' || {_ascii_sql('page')} WHEN text = '' THEN '' ELSE '"text": ' || {_ascii_sql('text')} END
    || '}}, "file_id": ' || doc_id || ', "file_size": ' || strlen(filename) || ', "filename": "' || filename || '", "headers": {{'
    || {_HEADERS_JSON} || '}}, "metadata": {{' || {_METADATA_JSON} || '}}}}'"""
_HASHED = f"h AS (SELECT doc_id, md5({_RECORD_JSON}) AS email_hash FROM m)"


def named_content(spark, sf_dir, **options):
    """The parsed messages, the length of the file's name standing for that of the file."""
    mail = messages(spark, sf_dir).drop("path").withColumn("file_id", F.col("doc_id"))
    return mime.parse_content(mail.withColumn("file_size", F.octet_length("filename").cast("bigint")), **options)


@query("email_hash", f"WITH {M}, {_HASHED} SELECT * FROM h")
def email_hash(spark, sf_dir):
    return named_content(spark, sf_dir).select("doc_id", mime.email_hash().alias("email_hash"))


@query("parse_outcomes", "SELECT count(*) AS total_files, count(*) AS successfully_parsed, 0 AS failed FROM documents")
def parse_outcomes(spark, sf_dir):
    return reports.parse_outcomes(content(spark, sf_dir).select("parse_error"))


@query("parse_summary", f"""WITH {M} SELECT count(*) AS total_files, count(*) AS successfully_parsed, 0 AS failed,
    count(*) FILTER (shape = 0) AS with_attachments, count(*) FILTER (shape = 0) AS total_attachments,
    count(DISTINCT sender) AS unique_senders, count(DISTINCT recipient) AS unique_recipients FROM m""")
def parse_summary(spark, sf_dir):
    return reports.parse_summary(content(spark, sf_dir).select("parse_error", "attachments", "metadata"))


@query("correspondents", f"""WITH {M} SELECT DISTINCT 'sender' AS role, sender AS address FROM m
    UNION ALL SELECT DISTINCT 'recipient', recipient FROM m""")
def correspondents(spark, sf_dir):
    return reports.correspondents(content(spark, sf_dir))


@query("message_preview", f"""WITH {M} SELECT doc_id, left(sender, 50) AS sender, left(recipient, 50) AS recipient,
    left(subject, 50) AS subject, CASE WHEN shape < 2 THEN left(text, 100) END AS text FROM m""")
def message_preview(spark, sf_dir):
    found = content(spark, sf_dir)
    return found.select(
        "doc_id", mime.preview("metadata.from").alias("sender"), mime.preview("metadata.to").alias("recipient"),
        mime.preview("metadata.subject").alias("subject"), mime.preview("body.text", 100).alias("text"),
    )


@query("enrich_messages", f"""WITH {M} SELECT doc_id, shape = 0 AS has_attachments,
    CASE WHEN shape = 0 THEN 1 ELSE 0 END AS attachment_count,
    CASE WHEN shape = 2 THEN length(page) ELSE length(text) END AS body_length FROM m""")
def enrich_messages(spark, sf_dir):
    return mime.enrich(content(spark, sf_dir)).select(
        "doc_id", "has_attachments", "attachment_count", "body_length"
    )


@query("file_ids", f"WITH {M} SELECT filename, row_number() OVER (ORDER BY filename) - 1 AS file_id FROM m")
def file_ids(spark, sf_dir):
    files = messages(spark, sf_dir).select("filename")
    return ordinals.with_ordinal(files, "filename", name="file_id")


@query("numbered_matches", f"""WITH {M} SELECT row_number() OVER (ORDER BY filename) AS number, filename, sender,
    subject, 1 AS attachments FROM m WHERE shape = 0""")
def numbered_matches(spark, sf_dir):
    matching = mime.enrich(content(spark, sf_dir)).filter(F.col("has_attachments").eqNullSafe(True)).select(
        "filename", F.col("metadata.from").alias("sender"), "metadata.subject",
        F.size("attachments").alias("attachments"),
    )
    # Stored before it is numbered, as numbering reads its rows more than once.
    numbered = ordinals.with_ordinal(stage(matching, "matches"), "filename")
    return numbered.select((F.col("ordinal") + 1).alias("number"), "filename", "sender", "subject", "attachments")


@query("with_attachments", f"WITH {M} SELECT doc_id, subject FROM m WHERE shape = 0")
def with_attachments(spark, sf_dir):
    found = mime.enrich(content(spark, sf_dir)).filter(
        F.col("has_attachments").eqNullSafe(True) & reports.has_attachments("attachments")
    )
    return found.select("doc_id", "metadata.subject")


_IDS = [1036, 1037, 1038, 1049, 1062, 1070, 36, 39, 0, 3]
_ID_LIST = ", ".join(str(i) for i in _IDS)


@query("messages_by_id", f"WITH {M} SELECT doc_id, subject FROM m WHERE doc_id IN ({_ID_LIST})")
def messages_by_id(spark, sf_dir):
    return content(spark, sf_dir, _IDS).select("doc_id", "metadata.subject")


@query("attachment_ids", f"WITH {M} SELECT doc_id AS file_id, 1 AS attachments FROM m WHERE shape = 0 AND doc_id <> 0")
def attachment_ids(spark, sf_dir):
    return reports.attachment_ids(content(spark, sf_dir))


@query("attachment_id_counts", f"""WITH {M} SELECT count(DISTINCT doc_id) AS unique_ids,
    count(*) FILTER (shape = 0) AS ids_with_attachments FROM m WHERE doc_id <> 0""")
def attachment_id_counts(spark, sf_dir):
    return reports.attachment_id_counts(content(spark, sf_dir))


@query("id_status", f"""WITH {M}, ids AS (SELECT unnest([{_ID_LIST}]) AS file_id) SELECT file_id,
    CASE WHEN file_id IN (SELECT doc_id FROM m WHERE shape = 0 AND doc_id <> 0) THEN 'EXISTS'
         ELSE 'NOT FOUND' END AS status FROM ids""")
def id_status(spark, sf_dir):
    ids = spark.createDataFrame([(i,) for i in _IDS], "file_id bigint")
    return reports.id_status(ids, content(spark, sf_dir, _IDS))


@query("flag_counts", f"""WITH {M}, f AS (SELECT * FROM m)
    SELECT count(*) FILTER (shape = 0) AS flag_true, count(*) FILTER (shape <> 0) AS flag_false,
    count(*) AS checked FROM f""")
def flag_counts(spark, sf_dir):
    return reports.flag_counts(mime.enrich(content(spark, sf_dir)), "filename")


@query("attachment_totals", f"""WITH {M} SELECT count(*) AS messages, count(*) FILTER (shape <> 1) AS attachments,
    count(*) FILTER (shape <> 1) AS messages_with_attachments FROM m""")
def attachment_totals(spark, sf_dir):
    return reports.attachment_totals(mime.parse_messages(messages(spark, sf_dir)))


@query("attachment_occurrence", f"""WITH {M}, a AS (SELECT doc_id, CASE WHEN shape = 0 THEN text ELSE source END AS t
    FROM m WHERE shape <> 1) SELECT sha256(t) AS sha256, count(DISTINCT doc_id) AS messages, count(*) AS copies,
    CAST(sum(octet_length(encode(t))) AS BIGINT) AS total_bytes FROM a GROUP BY 1""")
def attachment_occurrence(spark, sf_dir):
    return reports.attachment_occurrence(mime.parse_messages(messages(spark, sf_dir)), "doc_id")


@query("attachment_report", f"""WITH {M} SELECT doc_id AS "File ID", filename AS "Filename", sender AS "From",
    subject AS "Subject", CASE WHEN shape = 0 THEN 1 ELSE 0 END AS "Attachment Count",
    CASE WHEN shape = 0 THEN file END AS "Attachment Names" FROM m""")
def attachment_report(spark, sf_dir):
    path = new_path(spark, "report")
    report = loading.attachment_report(content(spark, sf_dir))
    loading.write_report(report, path)
    return spark.read.option("header", True).option("escape", '"').schema(report.schema).csv(path)


@query("keyword_match", f"WITH {M} SELECT doc_id FROM m WHERE sender = 'src1@en.example.com'")
def keyword_match(spark, sf_dir):
    found = content(spark, sf_dir).filter(F.col("metadata.from") == "src1@en.example.com")
    return found.select("doc_id")


@query("sample_docs", f"WITH {M} SELECT doc_id, subject FROM m ORDER BY filename LIMIT 3")
def sample_docs(spark, sf_dir):
    stored = content(spark, sf_dir).select("doc_id", "filename", "metadata.subject")
    return sources.sample_documents(stored, 3, "filename").drop("filename")


# --- stored JSON ----------------------------------------------------------
@query("write_json_roundtrip", f"WITH {M} SELECT {_FIRST} FROM m")
def write_json_roundtrip(spark, sf_dir):
    path = new_path(spark, "json")
    loading.write_json(loading.conform(mime.parse_messages(messages(spark, sf_dir)), MESSAGE), path)
    read = sources.read_json_lines(spark, path, MESSAGE)
    return first_form_view(read.withColumn("doc_id", _key("message_id")))


@query("scan_json_docs", f"WITH {M} SELECT doc_id, subject, CASE WHEN shape < 2 THEN md5({_BODY}) END AS text_md5 FROM m")
def scan_json_docs(spark, sf_dir):
    """Messages as JSON arrays, 500 to a file, read back."""
    path = new_path(spark, "arrays")
    docs = mime.parse_messages(messages(spark, sf_dir))
    block = F.floor(F.col("doc_id") / 500)
    arrays = docs.groupBy(block.alias("b")).agg(
        F.to_json(F.collect_list(F.struct("message_id", "subject", "body_text"))).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = sources.read_json_array(spark, path, MESSAGE)
    return read.select(_key("message_id"), "subject", F.md5(F.col("body_text").cast("binary")).alias("text_md5"))


@query("scan_json_glob", f"""WITH {M} SELECT doc_id, subject, CASE WHEN shape = 0 THEN 1 ELSE 0 END AS n_attachments,
    true AS named FROM m""")
def scan_json_glob(spark, sf_dir):
    """Every record as a JSON file of its own, read back with file names."""
    docs = content(spark, sf_dir).select("file_id", "metadata", "attachments")
    text = F.to_json(F.struct("file_id", "metadata", "attachments")).alias("value")
    read = sources.read_json_files(spark, single_files(docs.select(text), "objects"), CONTENT, "*.txt")
    return read.select(
        F.col("file_id").alias("doc_id"), "metadata.subject", F.size("attachments").alias("n_attachments"),
        F.endswith("source_file", F.lit(".txt")).alias("named"),
    )


# --- nested documents -----------------------------------------------------
def joined(spark, sf_dir):
    """Parsed messages with their frames; only keys are numbered, and the parser stands in the plan once."""
    mail, frames = messages(spark, sf_dir).drop("filename"), records(spark, sf_dir)
    pairs = ordinals.positional_pairs(mail, "path", frames, "event_id")
    return mime.parse_messages(mail).join(pairs.join(frames, "event_id", "left"), "path")


_JOINED = f"""{M}, {EXPORT}, f AS (SELECT *, row_number() OVER (ORDER BY event_id) AS i
    FROM (SELECT {RECORD_SQL} FROM x WHERE {_VALID})),
    j AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY filename) AS i FROM m) LEFT JOIN f USING (i))"""


@query("positional_join", f"WITH {_JOINED} SELECT doc_id, event_id, src_ip, dst_port, is_starttls FROM j")
def positional_join(spark, sf_dir):
    return joined(spark, sf_dir).select("doc_id", "event_id", "src_ip", "dst_port", "is_starttls")


_FINAL = f"""doc_id, date AS timestamp, sender, recipient, cc, message_id, subject, 'multipart' AS content_type,
    md5({_BODY}) AS text_md5, CASE WHEN shape = 2 THEN md5({_PAGE}) END AS html_md5, protocol,
    src_ip AS source_ip, src_port AS source_port, {_private('src_ip')} AS source_private,
    dst_ip AS destination_ip, {_private('dst_ip')} AS destination_private, smtp_req_command AS req_command,
    smtp_response_code AS response_code, is_starttls, frame_len,
    CASE WHEN shape = 1 THEN 0 ELSE 1 END AS n_attachments, false AS matched, false AS session_found"""


def final_view(docs):
    return docs.select(
        "doc_id", "timestamp", F.array_join("email.from", "|").alias("sender"),
        F.array_join("email.to", "|").alias("recipient"), F.array_join("email.cc", "|").alias("cc"),
        "message.message_id", "message.subject", "message.content_type",
        F.md5(strip_or_null("message.body_text").cast("binary")).alias("text_md5"),
        F.md5(F.col("message.body_html").cast("binary")).alias("html_md5"), "network.protocol",
        F.col("network.source.ip").alias("source_ip"), F.col("network.source.port").alias("source_port"),
        F.col("network.source.is_private").alias("source_private"),
        F.col("network.destination.ip").alias("destination_ip"),
        F.col("network.destination.is_private").alias("destination_private"),
        "smtp.req_command", "smtp.response_code", "smtp.is_starttls", "smtp.frame_len",
        F.size("attachments").alias("n_attachments"), "correlation.cgnat.matched", "correlation.radius.session_found",
    )


@query("final_docs", f"WITH {_JOINED} SELECT {_FINAL} FROM j")
def final_docs(spark, sf_dir):
    return final_view(loading.final_documents(joined(spark, sf_dir), "doc_id"))


@query("final_docs_table", f"WITH {_JOINED} SELECT {_FINAL} FROM j")
def final_docs_table(spark, sf_dir):
    """Final documents loaded into a table of the declared schema."""
    path = new_path(spark, "email-data")
    loading.replace_table(loading.final_documents(joined(spark, sf_dir)), FINAL_DOCUMENT, path)
    stored = spark.read.schema(FINAL_DOCUMENT).parquet(path)
    return final_view(stored.withColumn("doc_id", _key("message.message_id")))


# --- checked loads --------------------------------------------------------
def loaded_final(spark, sf_dir):
    """Final documents, some with a timestamp that is none, in milliseconds or missing; some frames have bad addresses."""
    kind = F.col("doc_id") % 7
    second = F.lit(1704067200) + F.col("doc_id") * 60
    rows = joined(spark, sf_dir).withColumn("date", F.when(kind == 3, "sometime").when(kind == 5, (second * 1000).cast("string"))
                                            .when(kind == 6, None).otherwise(F.col("date")))
    return checked_load.load_final_documents(rows, new_path(spark, "final"), "doc_id")


_LOAD_FINAL = f"""{_JOINED}, l AS (SELECT doc_id, i AS _id, src_ip, dst_ip, CASE WHEN doc_id % 7 = 3 THEN 'bad date: timestamp'
    WHEN NOT {_valid4('src_ip')} THEN 'bad ip: network.source.ip' WHEN NOT {_valid4('dst_ip')} THEN 'bad ip: network.destination.ip'
    END AS reason FROM j)"""


@query("load_final_docs", f"""WITH {_LOAD_FINAL} SELECT doc_id, _id, src_ip AS source_ip, dst_ip AS destination_ip,
    CASE WHEN doc_id % 7 NOT IN (3, 6) THEN (1704067200 + doc_id * 60) * 1000000 END AS instant_us,
    reason IS NULL AS accepted, reason FROM l""")
def load_final_docs(spark, sf_dir):
    return loaded_final(spark, sf_dir).rows(spark).select(
        "doc_id", "_id", F.col("network.source.ip").alias("source_ip"), F.col("network.destination.ip").alias("destination_ip"),
        F.unix_micros("instant").alias("instant_us"), "accepted", "reason")


@query("load_final_outcomes", f"WITH {_LOAD_FINAL} SELECT reason IS NULL AS accepted, reason, count(*) AS n FROM l GROUP BY 1, 2")
def load_final_outcomes(spark, sf_dir):
    return loaded_final(spark, sf_dir).outcomes(spark)


@query("load_first_failures", f"WITH {_LOAD_FINAL} SELECT _id, doc_id, reason FROM l WHERE reason IS NOT NULL ORDER BY _id LIMIT 5")
def load_first_failures(spark, sf_dir):
    return loaded_final(spark, sf_dir).first_failures(spark, "_id").select("_id", "doc_id", "reason")


_LOADED_CONTENT = f"""{M}, {_HASHED}, n AS (SELECT *, row_number() OVER (ORDER BY filename) - 1 AS i FROM m),
    l AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'email_' || i ELSE email_hash END AS _id,
    CASE WHEN doc_id % 11 = 4 THEN 'too long: metadata.message_id' END AS reason,
    CASE WHEN doc_id % 13 <> 6 THEN strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END AS date,
    shape, text, page, subject FROM n JOIN h USING (doc_id))"""


def loaded_content(spark, sf_dir):
    """Content documents; some have no hash, no readable date, or a message id that is too long."""
    mail = messages(spark, sf_dir)
    places = ordinals.with_ordinal(mail.select("filename"), "filename", name="place")
    found = named_content(spark, sf_dir).withColumn("email_hash", F.when(F.col("doc_id") % 5 != 0, mime.email_hash()))
    edited = F.col("metadata").withField("date", F.when(F.col("doc_id") % 13 == 6, "some day").otherwise(F.col("metadata.date"))).withField(
        "message_id", F.when(F.col("doc_id") % 11 == 4, F.repeat(F.lit("x"), 40000)).otherwise(F.col("metadata.message_id")))
    rows = found.withColumn("metadata", edited).join(places, "filename")
    return checked_load.load_content_documents(rows, new_path(spark, "content"), F.col("place"))


@query("load_content_docs", f"""WITH {_LOADED_CONTENT} SELECT doc_id, _id, date, subject, shape = 0 AS has_attachments,
    CASE WHEN shape = 0 THEN 1 ELSE 0 END AS attachment_count, CASE WHEN shape = 2 THEN length(page) ELSE length(text) END AS body_length,
    '{{"index":{{"_index":"email-content","_id":"' || _id || '"}}}}' AS action, reason IS NULL AS accepted, reason FROM l""")
def load_content_docs(spark, sf_dir):
    rows = loaded_content(spark, sf_dir).rows(spark)
    action = F.to_json(F.struct(F.struct(F.lit("email-content").alias("_index"), "_id").alias("index")))
    return rows.select("doc_id", "_id", "metadata.date", "metadata.subject", "has_attachments", "attachment_count", "body_length",
                       action.alias("action"), "accepted", "reason")


@query("load_content_outcomes", f"WITH {_LOADED_CONTENT} SELECT reason IS NULL AS accepted, reason, count(*) AS n FROM l GROUP BY 1, 2")
def load_content_outcomes(spark, sf_dir):
    return loaded_content(spark, sf_dir).outcomes(spark)


@query("parse_summary_file", f"""WITH {M} SELECT count(*) AS total_files, count(*) FILTER (doc_id % 17 <> 5) AS successfully_parsed,
    count(*) FILTER (doc_id % 17 = 5) AS failed, count(*) FILTER (shape = 0 AND doc_id % 17 <> 5) AS with_attachments,
    count(*) FILTER (shape = 0 AND doc_id % 17 <> 5) AS total_attachments,
    count(DISTINCT sender) FILTER (doc_id % 17 <> 5) AS unique_senders,
    count(DISTINCT recipient) FILTER (doc_id % 17 <> 5) AS unique_recipients, '2025-02-03T04:05:06.000000' AS parsing_time FROM m""")
def parse_summary_file(spark, sf_dir):
    """The summary written as JSON and read back; some messages are lost on the way and fail."""
    path = new_path(spark, "summary")
    mail = messages(spark, sf_dir).drop("path").withColumn("file_id", F.col("doc_id"))
    lost = mail.withColumn("content", F.when(F.col("doc_id") % 17 != 5, F.col("content")))
    found = mime.parse_content(lost).select("parse_error", "attachments", "metadata")
    reports.write_summary(found, path, F.lit("2025-02-03 04:05:06").cast("timestamp"))
    counts = ("total_files", "successfully_parsed", "failed", "with_attachments", "total_attachments", "unique_senders", "unique_recipients")
    return spark.read.schema(", ".join(f"{c} bigint" for c in counts) + ", parsing_time string").json(path)


# --- search in parsed mail ------------------------------------------------
# (query, all terms wanted, fields)
_MAIL_QUERIES = {
    1: ("Email PASSWORD", False, None), 2: ("report from SRC1", True, ["subject"]), 3: ("reader5 license", True, None),
    4: ("the of and", False, None), 5: ("en.example.com", True, ["from"]), 6: ("html license", True, ["html", "text"]),
}


def _analyzed_sql(x: str) -> str:
    return _ANALYZED.replace("lower(text)", f"lower(coalesce({x}, ''))")


_FIELD_SQL = {"from": "sender", "to": "recipient", "subject": "subject", "text": "CASE WHEN shape < 2 THEN text END",
              "html": "CASE WHEN shape = 2 THEN page END"}


def _found_sql(number: int) -> str:
    text, wants_all, fields = _MAIL_QUERIES[number]
    words = " || ".join(f"{_analyzed_sql(_FIELD_SQL[f])}" for f in fields or _FIELD_SQL)
    terms = f"list_distinct({_analyzed_sql(repr(text))})"
    enough = f"terms_met = len({terms})" if wants_all else "terms_met >= 1"
    return f"""SELECT {number} AS query_id, doc_id, terms_met, occurrences FROM (SELECT doc_id,
        len(list_intersect(list_distinct(w), {terms})) AS terms_met, len(list_filter(w, lambda x: list_contains({terms}, x))) AS occurrences
        FROM (SELECT doc_id, {words} AS w FROM m)) WHERE {enough} AND terms_met >= 1"""


@query("search_mail", f"WITH {M} " + " UNION ALL ".join(_found_sql(n) for n in _MAIL_QUERIES))
def search_mail(spark, sf_dir):
    """Several queries over sender, recipient, subject and bodies of all messages in one join."""
    asked = spark.createDataFrame([(n, *q) for n, q in _MAIL_QUERIES.items()],
                                  "query_id int, query string, wants_all boolean, fields array<string>")
    return mail_search.search(mail_search.mail_terms(content(spark, sf_dir), "doc_id", queries=asked), "doc_id", asked)

"""Queries over frames, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterscope.catalog.adapters import (
    CSV_CELLS, EXPORT_CELLS, export_frames, frames_sql, raw_frames,
)
from letterscope.functions import address, net, smtp
from letterscope.functions.text import digit_int, epoch_ts, safe_int, to_double
from letterscope.operators import distinct_sketches as sketching
from letterscope.operators import frames as fr
from letterscope.operators import checked_load, loading, ordinals, reports
from letterscope.operators.keyed_table import KeyedTable
from letterscope.sources import text_exports
from letterscope.staging import new_path

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return keep


# --- DuckDB side ----------------------------------------------------------
_WS = r"E' \t\n\r\x0b\x0c'"
_ADDRESS = r"'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'"


def _clean(x: str) -> str:
    return (
        f"CASE WHEN {x} NOT IN ('', 'N/A', 'NA', 'NaN', 'nan', 'None', 'null') THEN "
        f"nullif(trim(trim(trim(trim({x}, {_WS}), '\"'), ''''), {_WS}), '') END"
    )


def _after(t: str, m: str) -> str:
    piece = f"trim(translate(trim(string_split({t}, '{m}')[2], {_WS}), '<>', ''), {_WS})"
    return f"CASE WHEN contains({piece}, '@') THEN {piece} END"


def _address(t: str) -> str:
    return f"coalesce(nullif(regexp_extract({t}, {_ADDRESS}), ''), {_after(t, 'FROM:')}, {_after(t, 'TO:')})"


def _param(t: str) -> str:
    inner = f"trim(substr({t}, 2, length({t}) - 2), {_WS})"
    return f"coalesce({_address(t)}, CASE WHEN {t} LIKE '<%>' AND contains({inner}, '@') THEN {inner} END)"


def _private(x: str) -> str:
    octets = [f"CAST(split_part({x}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    n = f"({octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]})"
    ranges = [
        ("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12),
        ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15),
        ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4),
    ]
    tests = []
    for base, bits in ranges:
        low = sum(int(o) << (24 - 8 * i) for i, o in enumerate(base.split(".")))
        tests.append(f"{n} BETWEEN {low} AND {low + 2 ** (32 - bits) - 1}")
    return (
        f"CASE WHEN {_valid4(x)} THEN ({' OR '.join(tests)}) AND {x} NOT IN ('192.0.0.9', '192.0.0.10') END"
    )


def _valid4(x: str) -> str:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return f"regexp_full_match({x}, '{octet}([.]{octet}){{3}}')"


RAW = f"raw AS ({frames_sql()})"
CLEAN = RAW + ", c AS (SELECT event_id, " + ", ".join(
    f"{_clean(n.replace('.', '_'))} AS {n.replace('.', '_')}" for n in CSV_CELLS
) + " FROM raw)"
_COMMANDS = ["EHLO", "HELO", "MAIL", "RCPT", "DATA", "QUIT", "RSET", "AUTH", "STARTTLS", "VRFY", "EXPN",
             "HELP", "NOOP"]
_COMMAND = "CASE WHEN smtp_req_command IS NULL THEN NULL " + " ".join(
    f"WHEN contains(upper(smtp_req_command), '{c}') THEN '{c}'" for c in _COMMANDS
) + " ELSE 'OTHER' END"
_ENCRYPTED = """(coalesce(contains(upper(smtp_req_command), 'STARTTLS'), false)
    OR coalesce(contains(upper(smtp_response), 'TLS'), false)
    OR coalesce(tcp_dstport IN ('465', '587', '993', '995'), false))"""
_EPOCH_US = """CASE WHEN regexp_full_match(frame_time_epoch, '[0-9]+[.][0-9]{6}')
    THEN CAST(split_part(frame_time_epoch, '.', 1) AS BIGINT) * 1000000
       + CAST(split_part(frame_time_epoch, '.', 2) AS BIGINT) END"""


def _final(own: str) -> str:
    tries = [_address(own), _param("smtp_req_parameter"), own]
    return "coalesce(" + ", ".join(
        f"CASE WHEN contains({t}, '@') THEN nullif(trim({t}, {_WS}), '') END" for t in tries
    ) + ")"


KIND = CLEAN + f""", k AS (SELECT *, {_COMMAND} AS smtp_command, {_ENCRYPTED} AS is_encrypted,
    CASE WHEN {_ENCRYPTED} THEN 'ENCRYPTED' ELSE 'UNENCRYPTED' END AS encryption_status,
    CASE WHEN smtp_req_command IS NOT NULL THEN 'REQUEST' WHEN smtp_response_code IS NOT NULL
         THEN 'RESPONSE' ELSE 'UNKNOWN' END AS record_type,
    {_EPOCH_US} AS epoch_us,
    {_final('cflow_pie_ntop_smtp_mail_from')} AS final_from,
    {_final('cflow_pie_ntop_smtp_rcpt_to')} AS final_to
    FROM c)"""
EXPORT = "x AS (SELECT event_id, " + ", ".join(
    f"nullif({n.replace('.', '_')}, '') AS {n.replace('.', '_')}" for n in EXPORT_CELLS
) + f" FROM ({frames_sql(EXPORT_CELLS)}))"
_STARTTLS = """(coalesce(upper(trim(smtp_req_command)) = 'STARTTLS', false)
    OR coalesce(starts_with(upper(trim(smtp_command_line)), 'STARTTLS'), false))"""
_VALID = f"({_EPOCH_US}) IS NOT NULL AND ip_src IS NOT NULL AND ip_dst IS NOT NULL"


def _int(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN CAST({x} AS BIGINT) END"


RECORD_SQL = f"""event_id, {_EPOCH_US} AS epoch_us, ip_src AS src_ip, {_int('tcp_srcport')} AS src_port,
    ip_dst AS dst_ip, {_int('tcp_dstport')} AS dst_port, 'SMTP' AS protocol,
    smtp_command_line, smtp_req_command, smtp_req_parameter,
    {_int('smtp_response_code')} AS smtp_response_code, smtp_response,
    {_int('tcp_len')} AS tcp_len, {_int('frame_len')} AS frame_len, tls_record_content_type,
    {_STARTTLS} AS is_starttls"""


# --- Spark side -----------------------------------------------------------
def micros(column: str):
    """Epoch seconds as whole microseconds: integers compare exactly."""
    return F.rint(F.col(column) * 1e6).cast("bigint").alias("epoch_us")


def cleaned(spark, sf_dir):
    return fr.clean_frames(raw_frames(spark, sf_dir), keep=("event_id",))


def classified(spark, sf_dir):
    return fr.classify_frames(cleaned(spark, sf_dir))


def records(spark, sf_dir):
    return fr.frame_records(export_frames(spark, sf_dir))


def record_view(df):
    return df.select(*[micros("timestamp") if c == "timestamp" else c for c in df.columns])


@query("command_counts", f"""WITH {KIND} SELECT smtp_command, count(*) AS n FROM k
    WHERE smtp_command IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def command_counts(spark, sf_dir):
    return reports.value_counts(classified(spark, sf_dir), "smtp_command", reports.TOP)


@query("raw_command_counts", f"""WITH {RAW} SELECT smtp_req_command, count(*) AS n
    FROM (SELECT nullif(smtp_req_command, '') AS smtp_req_command FROM raw)
    WHERE smtp_req_command IS NOT NULL GROUP BY 1""")
def raw_command_counts(spark, sf_dir):
    raw = raw_frames(spark, sf_dir).withColumn(
        "smtp.req.command", F.nullif("`smtp.req.command`", F.lit(""))
    )
    return reports.value_counts(raw, "`smtp.req.command`")


@query("clean_frames", f"WITH {CLEAN} SELECT * FROM c")
def clean_frames(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query("smtp_command", f"WITH {KIND} SELECT event_id, smtp_req_command, smtp_command FROM k")
def smtp_command(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "event_id", "smtp_req_command", smtp.smtp_command("smtp_req_command").alias("smtp_command")
    )


@query("extract_addresses", f"""WITH {CLEAN} SELECT event_id,
    {_address('cflow_pie_ntop_smtp_mail_from')} AS from_email,
    {_address('cflow_pie_ntop_smtp_rcpt_to')} AS to_email FROM c""")
def extract_addresses(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "event_id",
        address.extract_address("cflow_pie_ntop_smtp_mail_from").alias("from_email"),
        address.extract_address("cflow_pie_ntop_smtp_rcpt_to").alias("to_email"),
    )


@query("param_address", f"""WITH {CLEAN} SELECT event_id, {_param('smtp_req_parameter')} AS param_email FROM c""")
def param_address(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "event_id", address.parameter_address("smtp_req_parameter").alias("param_email")
    )


@query("final_addresses", f"WITH {KIND} SELECT event_id, final_from, final_to FROM k")
def final_addresses(spark, sf_dir):
    return classified(spark, sf_dir).select("event_id", "final_from", "final_to")


@query("encryption_flag", f"WITH {KIND} SELECT event_id, is_encrypted FROM k")
def encryption_flag(spark, sf_dir):
    return classified(spark, sf_dir).select("event_id", "is_encrypted")


@query("encryption_split", f"WITH {KIND} SELECT encryption_status, count(*) AS n FROM k GROUP BY 1")
def encryption_split(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("encryption_status").agg(F.count("*").alias("n"))


@query("record_type", f"WITH {KIND} SELECT event_id, record_type FROM k")
def record_type(spark, sf_dir):
    return classified(spark, sf_dir).select("event_id", "record_type")


@query("digit_int", f"""WITH {CLEAN} SELECT event_id,
    CAST(CASE WHEN regexp_full_match(tcp_srcport, '[0-9]+') THEN tcp_srcport END AS INTEGER) AS source_port,
    CAST(CASE WHEN regexp_full_match(smtp_response_code, '[0-9]+') THEN smtp_response_code END AS INTEGER)
        AS response_code FROM c""")
def digits(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "event_id", digit_int("tcp_srcport").alias("source_port"),
        digit_int("smtp_response_code").alias("response_code"),
    )


@query("safe_int", f"""WITH {EXPORT} SELECT event_id, {_int('tcp_srcport')} AS src_port,
    {_int('smtp_response_code')} AS code, {_int('frame_len')} AS frame_len FROM x""")
def signed_ints(spark, sf_dir):
    return export_frames(spark, sf_dir).select(
        "event_id", safe_int("`tcp.srcport`").alias("src_port"),
        safe_int("`smtp.response.code`").alias("code"), safe_int("`frame.len`").alias("frame_len"),
    )


@query("epoch_ts", f"WITH {CLEAN} SELECT event_id, {_EPOCH_US} AS ts_us FROM c")
def epochs(spark, sf_dir):
    stamp = epoch_ts(to_double("frame_time_epoch"))
    return cleaned(spark, sf_dir).select("event_id", F.unix_micros(stamp).alias("ts_us"))


@query("is_private", f"""WITH {RAW} SELECT event_id, {_private('ip_src')} AS source_private,
    {_private('ip_dst')} AS destination_private, {_valid4('ip_dst')} AS destination_valid FROM raw""")
def private_flags(spark, sf_dir):
    return raw_frames(spark, sf_dir).select(
        "event_id", net.is_private("`ip.src`").alias("source_private"),
        net.is_private("`ip.dst`").alias("destination_private"),
        net.is_ip("`ip.dst`").alias("destination_valid"),
    )


_DOC_SQL = """event_id, epoch_us AS frame_us, ip_src AS source_ip, ip_dst AS destination_ip,
    CAST(CASE WHEN regexp_full_match(tcp_srcport, '[0-9]+') THEN tcp_srcport END AS INTEGER) AS source_port,
    CAST(CASE WHEN regexp_full_match(tcp_dstport, '[0-9]+') THEN tcp_dstport END AS INTEGER) AS destination_port,
    smtp_command, smtp_req_parameter AS smtp_parameter,
    CAST(CASE WHEN regexp_full_match(smtp_response_code, '[0-9]+') THEN smtp_response_code END AS INTEGER)
        AS response_code,
    smtp_response AS response_message, final_from AS from_email, final_to AS to_email,
    smtp_message AS email_message, is_encrypted, encryption_status, 'SMTP' AS protocol, record_type,
    epoch_us AS ts_us FROM k WHERE frame_time_epoch IS NULL OR epoch_us IS NOT NULL"""


def document_view(docs, *keys):
    others = [c for c in docs.columns if c not in ("frame_time_epoch", "timestamp", *keys)]
    return docs.select(
        *keys, micros("frame_time_epoch").alias("frame_us"), *others, F.unix_micros("timestamp").alias("ts_us")
    )


@query("traffic_docs", f"WITH {KIND} SELECT {_DOC_SQL}")
def traffic_docs(spark, sf_dir):
    return document_view(fr.traffic_documents(classified(spark, sf_dir), "event_id"), "event_id")


@query("traffic_summary", f"""WITH {KIND} SELECT count(*) AS total_records, count(smtp_command) AS with_command,
    count(smtp_response_code) AS with_response_code, count(*) FILTER (is_encrypted) AS encrypted,
    count(DISTINCT smtp_command) AS distinct_commands, count(DISTINCT ip_src) AS distinct_sources,
    count(DISTINCT ip_dst) AS distinct_destinations FROM k""")
def traffic_summary(spark, sf_dir):
    return reports.traffic_summary(classified(spark, sf_dir))


@query("distinct_sketches", f"""WITH {KIND} SELECT unnest(['smtp_command', 'ip_src', 'ip_dst']) AS "column",
    unnest([count(DISTINCT smtp_command), count(DISTINCT ip_src), count(DISTINCT ip_dst)]) AS exact, true AS within_bound FROM k""")
def distinct_sketches(spark, sf_dir):
    """Exact distinct counts beside the merged daily sketches' estimates."""
    columns = ["smtp_command", "ip_src", "ip_dst"]
    frames = classified(spark, sf_dir)
    sketches = sketching.daily_sketches(frames, "timestamp", columns)
    exact = frames.agg(*[F.countDistinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "exact")
    off = F.abs(F.col("estimate") - F.col("exact"))
    return exact.join(sketching.distinct_estimates(sketches, columns), "column").select(
        "column", "exact", (off <= sketching.error_bound() * F.col("exact")).alias("within_bound"))


@query("top_sources", f"""WITH {CLEAN} SELECT ip_src AS source_ip, count(*) AS n FROM c
    WHERE ip_src IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_sources(spark, sf_dir):
    return reports.value_counts(cleaned(spark, sf_dir), "ip_src", reports.TOP, "source_ip")


@query("top_destinations", f"""WITH {CLEAN} SELECT ip_dst AS destination_ip, count(*) AS n FROM c
    WHERE ip_dst IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_destinations(spark, sf_dir):
    return reports.value_counts(cleaned(spark, sf_dir), "ip_dst", reports.TOP, "destination_ip")


@query("traffic_timeline", f"""WITH {KIND} SELECT (epoch_us // 3600000000) * 3600000000 AS bucket_us,
    count(*) AS n FROM k WHERE epoch_us IS NOT NULL GROUP BY 1""")
def traffic_timeline(spark, sf_dir):
    return reports.timeline(classified(spark, sf_dir), "timestamp", 3600).select(
        F.unix_micros("bucket").alias("bucket_us"), "n"
    )


@query("auto_timeline", f"""WITH {KIND}, span AS (SELECT min(epoch_us) AS low, max(epoch_us) AS high FROM k),
    pick AS (SELECT low, high, (SELECT min(w) FROM (VALUES (1), (5), (10), (30), (60), (300), (600), (1800),
        (3600), (10800), (43200), (86400::BIGINT)) AS t(w) WHERE (high - low) / 1e6 / w + 1 <= 50) AS width FROM span),
    b AS (SELECT width, unnest(range(low // (width * 1000000), high // (width * 1000000) + 1)) AS i FROM pick)
    SELECT b.i * b.width * 1000000 AS bucket_us, b.width AS width_seconds, count(k.event_id) AS n
    FROM b LEFT JOIN k ON k.epoch_us // (b.width * 1000000) = b.i GROUP BY 1, 2""")
def auto_timeline(spark, sf_dir):
    return reports.auto_timeline(classified(spark, sf_dir), "timestamp").select(
        F.unix_micros("bucket").alias("bucket_us"), "width_seconds", "n"
    )


@query("starttls_frames", f"""WITH {RAW} SELECT event_id, smtp_req_command, smtp_req_parameter FROM raw
    WHERE upper(smtp_req_command) = 'STAR' AND upper(smtp_req_parameter) = 'TLS'""")
def starttls_frames(spark, sf_dir):
    found = fr.undot(fr.starttls_frames(raw_frames(spark, sf_dir)))
    return found.select("event_id", "smtp_req_command", "smtp_req_parameter")


@query("tls_sessions", f"""WITH {RAW} SELECT DISTINCT ip_src, ip_dst, tcp_srcport, tcp_dstport FROM raw
    WHERE upper(smtp_req_command) = 'STAR' AND upper(smtp_req_parameter) = 'TLS'""")
def tls_sessions(spark, sf_dir):
    return fr.tls_sessions(raw_frames(spark, sf_dir))


@query("starttls_flag", f"WITH {EXPORT} SELECT event_id, {_STARTTLS} AS is_starttls FROM x")
def starttls_flag(spark, sf_dir):
    return export_frames(spark, sf_dir).select(
        "event_id",
        smtp.is_starttls_frame("`smtp.req.command`", "`smtp.command_line`").alias("is_starttls"),
    )


@query("valid_frames", f"WITH {EXPORT} SELECT {RECORD_SQL} FROM x WHERE {_VALID}")
def valid_frames(spark, sf_dir):
    return record_view(records(spark, sf_dir))


@query("scan_frames", f"WITH {EXPORT} SELECT {RECORD_SQL.replace('event_id, ', '', 1)} FROM x WHERE {_VALID}")
def scan_frames(spark, sf_dir):
    """Frames written as a pipe export and read back."""
    path = new_path(spark, "export")
    raw = raw_frames(spark, sf_dir, EXPORT_CELLS)
    raw.select(F.concat_ws("|", *[f"`{c}`" for c in EXPORT_CELLS])).write.text(path)
    return record_view(fr.frame_records(text_exports.read_frame_export(spark, path)))


def write_csv_lines(spark, sf_dir):
    """Frames as comma lines under a header; trailing commas of some rows are cut off."""
    path = new_path(spark, "csv")
    raw = raw_frames(spark, sf_dir)
    line = F.concat_ws(",", *[f"`{c}`" for c in CSV_CELLS])
    ragged = F.when(F.col("event_id") % 10 == 0, F.regexp_replace(line, ",+$", "")).otherwise(line)
    raw.select(ragged.alias(",".join(CSV_CELLS))).write.option("header", True).option("quote", "").option(
        "sep", "\x01\x02").option("escape", "").csv(path)
    return path


_LINE = "concat_ws(',', " + ", ".join(c.replace(".", "_") for c in CSV_CELLS) + ")"
_RAGGED_SQL = f"""WITH {RAW}, l AS (SELECT string_split(trim(CASE WHEN event_id % 10 = 0
    THEN regexp_replace({_LINE}, ',+$', '') ELSE {_LINE} END), ',') AS p FROM raw) SELECT """ + ", ".join(
    f"coalesce(p[{i}], '') AS {c.replace('.', '_')}" for i, c in enumerate(CSV_CELLS[:-1], 1)
) + f", array_to_string(p[{len(CSV_CELLS)}:], ',') AS smtp_message FROM l"


@query("scan_ragged_csv", _RAGGED_SQL)
def scan_ragged_csv(spark, sf_dir):
    return fr.undot(text_exports.read_ragged_csv(spark, write_csv_lines(spark, sf_dir)))


@query("scan_quoted_csv", f"WITH {RAW} SELECT * EXCLUDE (event_id) FROM raw")
def scan_quoted_csv(spark, sf_dir):
    path = new_path(spark, "quoted")
    raw_frames(spark, sf_dir).drop("event_id").write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return fr.undot(text_exports.read_quoted_csv(spark, path, CSV_CELLS))


@query("doc_ids", """SELECT event_id, row_number() OVER (ORDER BY event_id) AS sequence_id,
    concat('record_', CAST(row_number() OVER (ORDER BY event_id) - 1 AS VARCHAR)) AS record_id,
    CASE WHEN event_id % 2 = 0 THEN md5(CAST(event_id AS VARCHAR))
         ELSE concat('email_', CAST(row_number() OVER (ORDER BY event_id) - 1 AS VARCHAR)) END AS hash_id
    FROM events""")
def doc_ids(spark, sf_dir):
    numbered = ordinals.with_ordinal(raw_frames(spark, sf_dir).select("event_id"), "event_id")
    key = F.when(F.col("event_id") % 2 == 0, F.md5(F.col("event_id").cast("string").cast("binary")))
    i = F.col("ordinal")
    return numbered.select(
        "event_id", ordinals.document_id(i, "sequence").alias("sequence_id"),
        ordinals.document_id(i, "record").alias("record_id"),
        ordinals.document_id(i, "hash", key).alias("hash_id"),
    )


def documents_with_id(spark, sf_dir):
    """Traffic documents keyed ``record_<n>``; the event id orders the frames, and is dense."""
    docs = fr.traffic_documents(classified(spark, sf_dir), "event_id")
    return docs.select(ordinals.document_id(F.col("event_id"), "record").alias("_id"), *docs.columns[1:])


_PAIR_FIELDS = ["source_ip", "destination_port", "smtp_command", "from_email", "is_encrypted", "response_code"]
_PAIR_SQL = f"""WITH {KIND}, d AS (SELECT {_DOC_SQL})
    SELECT concat('record_', CAST(event_id AS VARCHAR)) AS _id, 'email-traffic' AS _index, source_ip,
    destination_port, smtp_command, from_email, is_encrypted, response_code FROM d"""


@query("bulk_pairs", _PAIR_SQL)
def bulk_pairs(spark, sf_dir):
    pairs = loading.bulk_pairs(documents_with_id(spark, sf_dir), "email-traffic")
    action = F.from_json("action", "index struct<_index: string, _id: string>").alias("action")
    document = F.from_json("document", """source_ip string, destination_port int, smtp_command string, from_email string,
        is_encrypted boolean, response_code int""").alias("document")
    return pairs.select(action, document).select("action.index._id", "action.index._index", "document.*")


@query("scan_bulk_pairs", f"""SELECT CASE WHEN event_id % 29 = 0 THEN NULL ELSE _id END AS _id,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE _index END AS _index,
    {", ".join(f"CASE WHEN event_id % 31 = 0 AND event_id % 29 <> 0 THEN NULL ELSE {c} END AS {c}" for c in _PAIR_FIELDS)},
    CASE WHEN event_id % 29 = 0 THEN 'unreadable action' WHEN event_id % 31 = 0 THEN 'unreadable document' END AS problem
    FROM ({_PAIR_SQL.replace("SELECT concat('record_'", "SELECT event_id, concat('record_'")})""")
def scan_bulk_pairs(spark, sf_dir):
    """A bulk file of all documents read back; some actions and some documents in it are broken."""
    from letterscope.schemas import TRAFFIC_DOCUMENT

    path = new_path(spark, "bulk")
    pairs = loading.bulk_pairs(documents_with_id(spark, sf_dir), "email-traffic")
    event = F.regexp_extract("action", "record_([0-9]+)", 1).cast("bigint")
    loading.write_bulk_file(pairs.select(
        F.when(event % 29 == 0, F.regexp_replace("action", "}", "")).otherwise(F.col("action")).alias("action"),
        F.when((event % 29 != 0) & (event % 31 == 0), F.lit('{"source_ip": ')).otherwise(F.col("document")).alias("document")), path)
    read = text_exports.read_bulk_file(spark, path, TRAFFIC_DOCUMENT)
    return read.select(
        "_id", "_index", "_source.source_ip", "_source.destination_port", "_source.smtp_command",
        "_source.from_email", "_source.is_encrypted", "_source.response_code", "problem",
    )


@query("replace_table", f"WITH {KIND} SELECT {_DOC_SQL.replace('event_id, ', '', 1)}")
def replace_table(spark, sf_dir):
    from letterscope.schemas import TRAFFIC_DOCUMENT

    path = new_path(spark, "table")
    docs = fr.traffic_documents(classified(spark, sf_dir))
    loading.replace_table(docs, TRAFFIC_DOCUMENT, path)
    return document_view(spark.read.schema(TRAFFIC_DOCUMENT).parquet(path))


@query("upsert_docs", """WITH latest AS (SELECT user_id, arg_max(event_type, event_id) AS event_type,
    max(event_id) AS event_id FROM events WHERE event_id % 3 <> 0 GROUP BY 1),
    old AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
    FROM events WHERE event_id % 3 = 0 GROUP BY 1)
    SELECT * FROM latest UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM latest)""")
def upsert_docs(spark, sf_dir):
    """A third of the events is the stored table, the rest arrives as new writes."""
    from letterscope.catalog.adapters import table

    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    stored = loading.last_write(events.filter("event_id % 3 = 0"), "user_id", "event_id")
    return loading.upsert(stored, events.filter("event_id % 3 <> 0"), "user_id", "event_id")


@query("load_outcomes", f"""WITH {RAW}, t AS (SELECT *, CASE WHEN event_id % 5 = 4 THEN 'junk' ELSE '' END AS date
    FROM raw), v AS (SELECT CASE WHEN date = 'junk' THEN 'bad date: date'
    WHEN NOT {_valid4('ip_src')} THEN 'bad ip: ip_src'
    WHEN ip_dst <> '' AND NOT {_valid4('ip_dst')} THEN 'bad ip: ip_dst' END AS reason FROM t)
    SELECT reason IS NULL AS accepted, reason, count(*) AS n FROM v GROUP BY 1, 2""")
def load_outcomes(spark, sf_dir):
    """Every fifth frame carries an unreadable date; the others run through the accepted formats."""
    e = F.col("event_id")
    day = F.timestamp_seconds(F.lit(1704067200) + e * 60)
    date = (
        F.when(e % 5 == 4, F.lit("junk"))
        .when(e % 5 == 3, F.lit(None).cast("string"))
        .when(e % 5 == 2, (F.unix_seconds(day) * 1000).cast("string"))
        .when(e % 5 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0500")))
    )
    frames = fr.undot(raw_frames(spark, sf_dir)).withColumn("date", date).withColumn(
        "ip_dst", F.nullif("ip_dst", F.lit(""))
    )
    return reports.load_outcomes(loading.check_documents(frames, "date", "ip_src", "ip_dst"))


@query("discover", f"""WITH {KIND} SELECT event_id, epoch_us AS ts_us, smtp_command FROM k
    WHERE epoch_us BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-20')
    ORDER BY epoch_us DESC, event_id""")
def discover(spark, sf_dir):
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-20"))
    found = reports.discover(classified(spark, sf_dir), "timestamp", start, end, "event_id")
    return found.select("event_id", F.unix_micros("timestamp").alias("ts_us"), "smtp_command")


@query("load_traffic_docs", f"""WITH {KIND}, d AS (SELECT {_DOC_SQL}), l AS (SELECT event_id, source_ip, destination_ip, smtp_command,
    CASE WHEN NOT {_valid4('source_ip')} THEN 'bad ip: source_ip' WHEN NOT {_valid4('destination_ip')} THEN 'bad ip: destination_ip'
    END AS reason FROM d) SELECT *, reason IS NULL AS accepted FROM l""")
def load_traffic_docs(spark, sf_dir):
    """Traffic documents loaded into a table whose address columns take addresses only."""
    docs = fr.traffic_documents(classified(spark, sf_dir), "event_id")
    loaded = checked_load.load_traffic_documents(docs, new_path(spark, "traffic"))
    return loaded.rows(spark).select("event_id", "source_ip", "destination_ip", "smtp_command", "accepted", "reason")


_UPSERTS = """b0 AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events
    WHERE event_id % 5 = 0 AND user_id % 3 <> 0 GROUP BY 1), b1 AS (SELECT user_id, arg_max(event_type, event_id) AS event_type,
    max(event_id) AS event_id FROM events WHERE event_id % 5 IN (1, 2) AND user_id % 2 = 0 GROUP BY 1),
    b2 AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events
    WHERE event_id % 5 IN (3, 4) AND user_id % 5 = 1 GROUP BY 1)"""


def upserted_table(spark, sf_dir):
    """A stored table of each user's last event, and two upserts with later events of some users."""
    from letterscope.catalog.adapters import table

    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    stored = KeyedTable.create(spark, new_path(spark, "users"), "user_id bigint, event_type string, event_id bigint", "user_id", 16)
    batches = ["event_id % 5 = 0 AND user_id % 3 <> 0", "event_id % 5 IN (1, 2) AND user_id % 2 = 0",
               "event_id % 5 IN (3, 4) AND user_id % 5 = 1"]
    return stored, [stored.upsert(events.filter(b), "event_id") for b in batches]


@query("stored_upsert", f"""WITH {_UPSERTS}, late AS (SELECT * FROM b2 UNION ALL SELECT * FROM b1 WHERE user_id NOT IN (SELECT user_id FROM b2))
    SELECT * FROM late UNION ALL SELECT * FROM b0 WHERE user_id NOT IN (SELECT user_id FROM late)""")
def stored_upsert(spark, sf_dir):
    return upserted_table(spark, sf_dir)[0].read()


@query("upsert_outcomes", f"""WITH {_UPSERTS}, u AS (SELECT 1 AS version, user_id, false AS known FROM b0
    UNION ALL SELECT 2, user_id, user_id IN (SELECT user_id FROM b0) FROM b1
    UNION ALL SELECT 3, user_id, user_id IN (SELECT user_id FROM b0) OR user_id IN (SELECT user_id FROM b1) FROM b2)
    SELECT version, count(*) FILTER (NOT known) AS inserted, count(*) FILTER (known) AS updated FROM u GROUP BY 1""")
def upsert_outcomes(spark, sf_dir):
    """What each of the three writes did, as counted by the job that wrote."""
    rows = [(u.version, u.inserted, u.updated) for u in upserted_table(spark, sf_dir)[1]]
    return spark.createDataFrame(rows, "version int, inserted bigint, updated bigint")


@query("scan_session_csv", f"""WITH {RAW} SELECT ip_src, nullif(ip_dst, '') AS ip_dst, smtp_req_command, smtp_req_parameter FROM raw
    WHERE upper(smtp_req_command) = 'STAR' AND upper(smtp_req_parameter) = 'TLS'""")
def scan_session_csv(spark, sf_dir):
    """STARTTLS frames of a header CSV whose column names stand between blanks."""
    path = new_path(spark, "sessions")
    names = ["ip.src", "ip.dst", "smtp.req.command", "smtp.req.parameter"]
    raw = raw_frames(spark, sf_dir).select(*[F.col(f"`{n}`").alias(f" {n} ") for n in names])
    raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    read = text_exports.read_session_csv(spark, path, ", ".join(f"` {n} ` string" for n in names))
    return fr.undot(fr.starttls_frames(read))

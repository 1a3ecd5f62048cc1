"""Classification of SMTP frames.

Three tests for TLS exist and disagree on the same frame, so each keeps its own
name: :func:`is_starttls_frame` (frame export), :func:`is_encrypted` (traffic
documents) and :func:`is_starttls_short` (4-character command column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col, bind, contains_any_case, strip

# Fixed values -------------------------------------------------------------
COMMANDS = [
    "EHLO", "HELO", "MAIL", "RCPT", "DATA", "QUIT", "RSET",
    "AUTH", "STARTTLS", "VRFY", "EXPN", "HELP", "NOOP",
]
TLS_PORTS = ["465", "587", "993", "995"]
# --------------------------------------------------------------------------


def smtp_command(command: Column | str) -> Column:
    """First listed command contained in the text, ``OTHER`` if none, null stays null."""
    def first(text: Column) -> Column:
        tests = [F.when(F.contains(text, F.lit(name)), F.lit(name)) for name in COMMANDS]
        return F.when(text.isNotNull(), F.coalesce(*tests, F.lit("OTHER")))

    return bind(F.upper(strip(command)), first)


def is_starttls_frame(command: Column | str, command_line: Column | str) -> Column:
    """STARTTLS as the whole request command, or at the start of the command line."""
    tests = [
        F.upper(strip(command)) == F.lit("STARTTLS"),
        F.startswith(F.upper(strip(command_line)), F.lit("STARTTLS")),
    ]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def is_starttls_short(command: Column | str, parameter: Column | str) -> Column:
    """The dissector's split form: command ``STAR`` with parameter ``TLS``."""
    both = (F.upper(as_col(command)) == "STAR") & (F.upper(as_col(parameter)) == "TLS")
    return F.coalesce(both, F.lit(False))


def is_encrypted(command: Column | str, response: Column | str, destination_port: Column | str) -> Column:
    """STARTTLS in the command, TLS in the response, or a TLS destination port (as text)."""
    port = F.coalesce(as_col(destination_port).isin(TLS_PORTS), F.lit(False))
    return contains_any_case(command, "STARTTLS") | contains_any_case(response, "TLS") | port


def encryption_status(encrypted: Column | str) -> Column:
    return F.when(as_col(encrypted), F.lit("ENCRYPTED")).otherwise(F.lit("UNENCRYPTED"))


def record_type(command: Column | str, response_code: Column | str) -> Column:
    return (
        F.when(as_col(command).isNotNull(), F.lit("REQUEST"))
        .when(as_col(response_code).isNotNull(), F.lit("RESPONSE"))
        .otherwise(F.lit("UNKNOWN"))
    )

"""Search in parsed mail, many queries at once.

Texts become a table of their terms once; a set of queries is then one join
with it.  A query that wants all its terms is a division: messages that meet as
many of its terms as it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterscope.functions.search import analyze

FIELDS = {"from": "metadata.from", "to": "metadata.to", "subject": "metadata.subject", "text": "body.text", "html": "body.html"}


def mail_terms(content: DataFrame, key: str, fields: dict[str, str] | None = None, queries: DataFrame | None = None) -> DataFrame:
    """``key, field, term, occurrences`` of parsed messages; fields without words have no rows.

    Worth storing.  A group is one term of one field of one message, so no
    common word gathers in one task.  If only some ``queries`` will be asked,
    other terms than theirs go before they are counted; the queries' terms are
    broadcast.
    """
    named = [F.struct(F.lit(name).alias("field"), analyze(column).alias("terms")) for name, column in (fields or FIELDS).items()]
    words = content.select(key, F.inline(F.array(*named))).select(key, "field", F.explode("terms").alias("term"))
    if queries is not None:
        words = words.join(F.broadcast(query_terms(queries).select("term").distinct()), "term", "left_semi")
    return words.groupBy(key, "field", "term").agg(F.count("*").alias("occurrences"))


def query_terms(queries: DataFrame) -> DataFrame:
    """``query_id, wants_all, fields, n_terms, term`` of queries (query_id, query, wants_all, fields), analysed like the texts.

    ``fields`` lists the fields to look in, null for all.
    """
    terms = F.array_distinct(analyze("query"))
    return queries.select("query_id", "wants_all", "fields", terms.alias("terms")).select(
        "query_id", "wants_all", "fields", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))


def search(terms: DataFrame, key: str, queries: DataFrame) -> DataFrame:
    """``query_id``, ``key``, ``terms_met`` and ``occurrences`` of every message that a query finds.

    A query of stop words only finds nothing.  Only terms that some query asks
    for pass the join; what is counted afterwards is spread over messages.
    """
    wanted = query_terms(queries)
    met = terms.join(wanted, "term").filter(F.col("fields").isNull() | F.array_contains("fields", F.col("field")))
    by_message = met.groupBy("query_id", key).agg(
        F.count_distinct("term").alias("terms_met"), F.sum("occurrences").alias("occurrences"),
        F.first("n_terms").alias("n_terms"), F.first("wants_all").alias("wants_all"))
    return by_message.filter(~F.col("wants_all") | (F.col("terms_met") == F.col("n_terms"))).drop("n_terms", "wants_all")


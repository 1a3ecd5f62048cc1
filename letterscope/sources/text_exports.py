"""Frame exports (pipe text, ragged CSV, quoted CSV) and bulk files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from letterscope.functions.text import empty_to_null, strip
from letterscope.schemas import FRAME_EXPORT_COLUMNS
from letterscope.sources.split_records import count_of, pieces, records
from letterscope.staging import stage

# A separator no export contains: the CSV reader then hands over whole lines
# and itself drops the header line of every file.
_NO_SEPARATOR = "\x01\x02"


def quoted(name: str) -> str:
    return "`" + name + "`"


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines with their exact 0-based number in each file.

    Columns: file_path, file_name, line_no, value.  Every file split numbers
    its own lines; adding up the line counts of the earlier splits of the same
    file gives the rest, so no file has to pass through one task.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("split_start"),
            strip("value").alias("value"),
        )
        .filter(F.col("value") != "")
        .withColumn("row", F.monotonically_increasing_id())
    )
    kept = stage(lines, "lines")
    splits = kept.groupBy("file_path", "split_start").agg(
        F.min("row").alias("first_row"), F.count("*").alias("n")
    )
    earlier = (
        Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = splits.select(
        "file_path", "split_start",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_row")).alias("shift"),
    )
    return kept.join(starts, ["file_path", "split_start"]).select(
        "file_path", "file_name", (F.col("row") + F.col("shift")).alias("line_no"), "value"
    )


def split_export_line(line: Column | str) -> list[Column]:
    """The 13 positional cells of one pipe-separated line; missing and empty are null."""
    cells = F.split(strip(line), "[|]", -1)
    return [
        empty_to_null(F.get(cells, F.lit(i))).alias(name) for i, name in enumerate(FRAME_EXPORT_COLUMNS)
    ] + [F.size(cells).alias("n_fields")]


def read_frame_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pipe-separated frame export: 13 text columns plus ``n_fields``."""
    return spark.read.text(path).select(*split_export_line("value"))


def export_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the first line of an export file."""
    first = (
        spark.read.text(path)
        .filter(F.col("_metadata.file_block_start") == 0)
        .select(strip("value").alias("value"))
        .first()
    )
    return first["value"].split(",") if first else []


def split_ragged(line: Column | str, header: list[str]) -> list[Column]:
    """Cells of a comma line: extra cells stay joined in the last column, missing ones are empty."""
    cells = F.split(strip(line), ",", len(header))
    return [
        F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(header)
    ]


def read_ragged_csv(spark: SparkSession, path: str | list[str], header: list[str] | None = None) -> DataFrame:
    """CSV whose rows have too few or too many cells; quotes mean nothing, all cells are text."""
    header = header or export_header(spark, path)
    lines = (
        spark.read.option("header", True).option("sep", _NO_SEPARATOR).option("quote", "")
        .option("escape", "").schema(T.StructType([T.StructField("value", T.StringType())])).csv(path)
    )
    return lines.filter(strip("value") != "").select(*split_ragged("value", header))


def read_quoted_csv(spark: SparkSession, path: str | list[str], header: list[str]) -> DataFrame:
    """Well-formed CSV with quotes and a header line; a malformed row is an error.

    Values may hold line breaks.  A line ends a row if the quotes up to it are
    even in number, so a file is read by as many tasks as it has splits.
    """
    lines = pieces(spark, path)
    none = F.lit(0)
    rows = records(lines.select("*", count_of(F.col("value"), '"').alias("flips"), none.alias("if_even"), none.alias("if_odd")), "\n")
    text = F.regexp_replace("value", "\r\\z", "")
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed in "), "file_path"))
    kept = rows.filter(F.when(~F.col("closed"), unclosed).otherwise(~F.col("first") & (text != "")))
    schema = ", ".join(f"{quoted(name)} string" for name in header)
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    return kept.select(F.from_csv(text, schema, options).alias("row")).select(
        *[F.coalesce(F.col("row")[name], F.lit("")).alias(name) for name in header])


def read_session_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Header CSV with a declared schema and trimmed column names."""
    raw = spark.read.option("header", True).schema(schema).csv(path)
    return raw.toDF(*[name.strip() for name in raw.columns])


def read_bulk_file(spark: SparkSession, path: str | list[str], document: str | T.StructType) -> DataFrame:
    """Action and document lines, paired in file order; blank lines do not count.

    Columns: file_name, pair_no, _index, _id, _source, problem.  A line without
    its partner, or one that does not parse, is reported in ``problem``.  Pairs
    are made inside each split; only lines at split borders move.
    """
    lines = pieces(spark, path).withColumn("value", strip("value")).filter(F.col("value") != "")
    none = F.lit(0)
    pairs = records(lines.select("*", F.lit(1).alias("flips"), none.alias("if_even"), none.alias("if_odd")), "\n")
    halves = F.split("value", "\n", 2)
    read = pairs.select(
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        F.floor((F.col("at") - 1) / 2).alias("pair_no"),
        F.from_json(halves[0], "index struct<_index: string, _id: string>").alias("action"),
        F.get(halves, F.lit(1)).alias("document_line"),
    ).withColumn("_source", F.from_json("document_line", document))
    problem = (
        F.when(F.col("document_line").isNull(), F.lit("action without document"))
        .when(F.col("action.index._id").isNull(), F.lit("unreadable action"))
        .when(F.try_parse_json("document_line").isNull(), F.lit("unreadable document"))
    )
    return read.select(
        "file_name", "pair_no", "action.index._index", "action.index._id", "_source", problem.alias("problem"))

"""Raw message files and JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from letterscope.sources.split_records import count_of, pieces, records


# A task reads about so many files or bytes; there are eight tasks a core at least, as far as Spark makes them.
TASK_FILES, TASK_BYTES = 2048, 1 << 28


def in_fewer_tasks(files: DataFrame) -> DataFrame:
    """A table of files, read by fewer tasks where these are small.

    Spark counts a file as 4 MB at least, so a task gets 32 small ones and
    takes longer to start and end than to read them.  No row moves.
    """
    n = len(files._jdf.inputFiles())
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files.coalesce(max(8 * files.sparkSession.sparkContext.defaultParallelism, n // TASK_FILES, size // TASK_BYTES))


def read_messages(
    spark: SparkSession, path: str | list[str], pattern: str | None = None, min_bytes: int = 0
) -> DataFrame:
    """Message files as ``path, filename, file_size, content``.

    ``pattern='*.eml'`` keeps one extension.  Smaller files than ``min_bytes`` go
    (50 takes out artifacts); the test is pushed into the file listing, so they
    are never opened.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    return in_fewer_tasks(files.filter(F.col("length") >= min_bytes)).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("file_size"),
        "content",
    )


def file_census(spark: SparkSession, path: str | list[str], pattern: str | None = None, min_bytes: int = 0) -> DataFrame:
    """What :func:`read_messages` keeps and drops by size: files, too_small, bytes_kept.  No file is opened."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    kept = F.col("length") >= min_bytes
    return in_fewer_tasks(reader.load(path).select("length")).agg(
        F.count("*").alias("files"), F.count_if(~kept).alias("too_small"),
        F.coalesce(F.sum(F.when(kept, F.col("length"))), F.lit(0)).alias("bytes_kept"))


def read_json_array(spark: SparkSession, path: str | list[str], schema: str | StructType) -> DataFrame:
    """Files holding one JSON array of objects each; unreadable input is an error.

    A file is read by as many tasks as it has splits.  It is taken apart at
    closing braces; quotes without escaped ones tell whether a brace stands in
    a string, and the depth of brackets outside strings whether it ends a document.
    """
    parts = pieces(spark, path, "}")
    # Escaped characters cannot open, close or quote; of the rest every second part between quotes lies in a string.
    between = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def shift(odd: int) -> Column:
        outside = F.array_join(F.filter(between, lambda _, i: i % 2 == odd), "")
        # The brace that ended the piece closes, unless it stands in a string.
        closed = F.when((F.size(between) - 1) % 2 == odd, 1).otherwise(0)
        return count_of(outside, "{[") - count_of(outside, "]") - closed

    state = parts.select("*", (F.size(between) - 1).alias("flips"), shift(0).alias("if_even"), shift(1).alias("if_odd"))
    found = records(state, "}", end_depth=1)
    text = F.col("value")
    opened = F.when(F.col("first"), text.rlike(r"^\s*\[\s*\{")).otherwise(text.rlike(r"^\s*,\s*\{"))
    empty = F.col("first") & text.rlike(r"^\s*\[\s*\]\s*\z")
    finished = F.when(F.col("closed"), opened & F.coalesce("rest", F.lit(True))).otherwise(text.rlike(r"^\s*\]\s*\z") | empty)
    broken = F.raise_error(F.concat(F.lit("not an array of JSON objects: "), "file_path"))
    documents = found.filter(F.when(finished, F.col("closed")).otherwise(broken))
    document = F.concat(F.regexp_replace("value", r"^\s*[\[,]\s*", ""), F.lit("}"))
    return documents.select(F.from_json(document, schema, {"mode": "FAILFAST"}).alias("document")).select("document.*")


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_files(spark: SparkSession, path: str | list[str], schema: str | StructType, pattern: str = "*.json") -> DataFrame:
    """One JSON object per file, with the file's name; unreadable files are skipped."""
    files = (
        spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED")
        .option("pathGlobFilter", pattern).json(path)
    )
    return in_fewer_tasks(files.select("*", F.col("_metadata.file_name").alias("source_file")))


def sample_documents(table: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` documents in a stated order."""
    return table.orderBy(*order).limit(n)

"""Frame exports that keep arriving: the same row functions on a stream.

Cleaning and classifying hold no state, so a folder of rotated exports can be
loaded file by file as it grows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from letterscope.functions.text import strip
from letterscope.operators.frames import classify_frames, clean_frames, traffic_documents
from letterscope.sources.text_exports import split_ragged


def load_new_exports(
    spark: SparkSession, source: str, header: list[str], table: str, progress: str
) -> StreamingQuery:
    """Append traffic documents of files not seen before, then stop.

    ``progress`` is the stream's checkpoint folder; it remembers the files.
    """
    lines = spark.readStream.text(source)
    rows = lines.filter(lines.value != ",".join(header)).filter(strip("value") != "")
    documents = traffic_documents(classify_frames(clean_frames(rows.select(*split_ragged("value", header)))))
    return (
        documents.writeStream.format("parquet").option("path", table)
        .option("checkpointLocation", progress).outputMode("append").trigger(availableNow=True).start()
    )

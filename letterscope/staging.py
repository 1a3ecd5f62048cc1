"""Tables written once to the cluster's shared folder and read back.

Numbering rows needs one fixed set of partitions that several later jobs agree
on.  A written table gives that: it survives lost executors, and later reads
prune columns.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files a folder of single files holds; of many folders, each is listed by a task.
FOLDER_FILES = 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may go without the setting; a cluster
    must name a folder every executor can reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="letterscope-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/letterscope/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it; null if it lies in a store that only Hadoop opens."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(context._jsc.hadoopConfiguration())
    return store.makeQualified(place).toUri().getPath() if store.getUri().getScheme() == "file" else None


def _file_writer(top: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that writes each text to a file of its own below ``top`` and returns the folders it filled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No other attempt has this number: what a failed one leaves is in folders nobody reads.
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        written, folders = 0, []
        for batch in batches:
            for text in batch.column(0):
                if written % FOLDER_FILES == 0:
                    folders.append(f"{attempt}-{len(folders)}")
                    os.mkdir(f"{top}/{folders[-1]}")
                with open(f"{top}/{folders[-1]}/part-{task:05d}-c{written:03d}.txt", "xb") as file:
                    if text.is_valid:
                        file.write(text.as_buffer())
                    file.write(b"\n")
                written += 1
        yield pa.record_batch({"folder": pa.array(folders, pa.string())})

    return run


def on_all_cores(table: DataFrame) -> DataFrame:
    """``table`` on all cores; rows move only if one partition holds over twice a core's share, as a large row group does."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    held = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    return table.repartition(cores) if held and max(held) * cores > 2 * sum(held) else table


def single_files(texts: DataFrame, label: str) -> list[str]:
    """Write each row of the one text column as a file of its own, as Spark's text writer does; returns their folders.

    Where the shared folder is a mounted one, Spark's writer makes Hadoop start
    processes for every file to set its mode, and the driver moves each file
    once more; there the tasks write the files themselves.
    """
    spark = texts.sparkSession
    path = new_path(spark, label)
    top = local_folder(spark, path)
    if top is None:
        texts.write.option("maxRecordsPerFile", 1).text(path)
        return [path]
    os.makedirs(top)
    folders = texts.mapInArrow(_file_writer(top), "folder string").collect()
    return [f"{path}/{r['folder']}" for r in folders] or [path]

"""Records that span several lines, read from file splits by many tasks.

Where a record ends can depend on everything before it in the file: on whether
a quote is open, how deep brackets are nested, or whether a line count is even.
Each piece of a file (a line, or what lies between two separators) changes that
state by a bit that flips and a depth that shifts, and the shift may depend on
the bit.  So

1. every split tells, for both bits it might start with, what it does to the state;
2. the splits of a file are chained in order, which gives each its first state;
3. every split cuts its pieces into records; only its first record and what is
   left open at its end move, to be joined with those of neighbouring splits.

No file passes through one task, and what moves are at most two rows for each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INNER, HEAD, TAIL = 0, 1, 2
_OUT = "file_path string, split_start long, kind int, at long, value string"
_OUT_ARROW = pa.schema([("file_path", pa.string()), ("split_start", pa.int64()), ("kind", pa.int32()),
                        ("at", pa.int64()), ("value", pa.string())])
_FLUSH = 1 << 22


def pieces(spark: SparkSession, path: str | list[str], separator: str = "\n") -> DataFrame:
    """The text between separators, in file order within each split: file_path, split_start, value."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    )


def _split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of batches that belong to one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names, starts = batch.column("file_path"), batch.column("split_start")
        start_values = starts.to_numpy(zero_copy_only=False)
        codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(start_values) != 0) | (np.diff(codes) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield (names[int(a)].as_py(), int(start_values[a])), batch.slice(int(a), int(b - a))


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: flips, and the shift of depth if it starts with either bit."""
    key, total = None, [0, 0, 0]
    rows = []
    for own, batch in _split_runs(batches):
        if own != key:
            if key:
                rows.append((*key, *total))
            key, total = own, [0, 0, 0]
        flips, even, odd = _numbers(batch, "flips", "if_even", "if_odd")
        bit = (total[0] + np.cumsum(flips) - flips) & 1
        total = [total[0] + int(flips.sum()), total[1] + int(np.where(bit == 0, even, odd).sum()),
                 total[2] + int(np.where(bit == 1, even, odd).sum())]
    if key:
        rows.append((*key, *total))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                         names=["file_path", "split_start", "flips", "shift_even", "shift_odd"])


def _starts(measured: DataFrame) -> DataFrame:
    """The state in which each split starts: flips before it, and depth."""
    before = Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    counted = measured.withColumn("flips_before", F.coalesce(F.sum("flips").over(before), F.lit(0)))
    shift = F.when(F.col("flips_before") % 2 == 0, F.col("shift_even")).otherwise(F.col("shift_odd"))
    return (
        counted.withColumn("shift", shift)
        .select("file_path", "split_start", "flips_before",
                F.coalesce(F.sum("shift").over(before), F.lit(0)).alias("depth_before"))
    )


def _cutter(joint: str, end_depth: int):
    """Cuts the pieces of each split into records: those inside, the first one, and what is left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        key, open_, flips_now, depth_now, seen = None, [], 0, 0, False

        def rest() -> None:
            if key and open_:
                out.append((*key, TAIL, flips_now, joint.join(open_)))

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT_ARROW, strict=True)], schema=_OUT_ARROW)

        for own, batch in _split_runs(batches):
            if own != key:
                rest()
                key, open_, seen = own, [], False
                flips_now, depth_now = batch.column("flips_before")[0].as_py(), batch.column("depth_before")[0].as_py()
            flips, even, odd = _numbers(batch, "flips", "if_even", "if_odd")
            count = flips_now + np.cumsum(flips)
            depth = depth_now + np.cumsum(np.where((count - flips) % 2 == 0, even, odd))
            ends = np.flatnonzero((count % 2 == 0) & (depth == end_depth))
            values, a = batch.column("value").to_pylist(), 0
            for b in ends:
                open_.extend(values[a : b + 1])
                out.append((*key, INNER if seen else HEAD, int(count[b]), joint.join(open_)))
                size += len(out[-1][-1])
                open_, seen, a = [], True, b + 1
                if size > _FLUSH:
                    yield flushed()
                    out, size = [], 0
            open_.extend(values[a:])
            flips_now, depth_now = int(count[-1]), int(depth[-1])
        rest()
        if out:
            yield flushed()

    return run


def records(measured_pieces: DataFrame, joint: str, end_depth: int = 0) -> DataFrame:
    """Records of pieces that tell how they change the state.

    ``measured_pieces``: file_path, split_start, value in scan order, ``flips``
    (how often the bit flips), ``if_even`` and ``if_odd`` (shift of depth when
    the piece starts with an even or odd number of flips).  A record ends with a
    piece after which flips are even and depth is ``end_depth``; its pieces are
    put together with ``joint``.

    Result: file_path, at (flips up to its end), value, first (of its file), closed
    (false for what is left after a file's last record), and on the first and
    other records at split borders ``rest``: whether the file has such a rest.
    """
    state = measured_pieces.select("file_path", "split_start", "flips", "if_even", "if_odd")
    measured = state.mapInArrow(
        _measured, "file_path string, split_start long, flips long, shift_even long, shift_odd long")
    # One row for each split of the input, of which the driver holds a task anyway; a broadcast keeps scan order.
    placed = measured_pieces.join(F.broadcast(_starts(measured)), ["file_path", "split_start"])
    cut = placed.mapInArrow(_cutter(joint, end_depth), _OUT)
    borders = cut.filter(F.col("kind") != INNER)
    by_split = Window.partitionBy("file_path").orderBy("split_start", "kind")
    closes = (F.col("kind") == HEAD).cast("int")
    grouped = borders.withColumn("record", F.coalesce(F.sum(closes).over(
        by_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("split_start", "kind", "value")))
    joined = grouped.groupBy("file_path", "record").agg(
        F.max("at").alias("at"), F.array_join(F.transform(parts, lambda p: p["value"]), joint).alias("value"),
        (F.max(closes) == 1).alias("closed"))
    ends = joined.select("file_path", "at", "value", (F.col("record") == 0).alias("first"), "closed",
                         (~F.min("closed").over(Window.partitionBy("file_path"))).alias("rest"))
    inside = cut.filter(F.col("kind") == INNER).select(
        "file_path", "at", "value", F.lit(False).alias("first"), F.lit(True).alias("closed"), F.lit(None).cast("boolean").alias("rest"))
    return ends.union(inside)


def count_of(value: Column, characters: str) -> Column:
    """How many characters of ``value`` are among ``characters``."""
    return F.length(value) - F.length(F.translate(value, characters, ""))

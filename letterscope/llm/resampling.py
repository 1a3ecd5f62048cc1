"""Quality by importance resampling: documents drawn by how much likelier the target's model makes them.

Two bag-of-n-gram models over hashed buckets are counted: one on all documents,
one on documents labelled good.  A document's weight is the log ratio of its
likelihoods; adding Gumbel noise and taking the k largest draws k documents
without replacement in proportion to the ratio.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterscope.llm.common import Staged
from letterscope.llm.textvec import frames, mix, shingles, words
from letterscope.operators.ordinals import with_ordinal

BUCKETS, SEED, SMOOTHING = 1 << 14, 5, 1.0


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of neighbouring words, and the number of each text's row."""
    hashes, first = words(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs = shingles(hashes, 2)
    inside = row[1:] == row[:-1]
    every = np.concatenate([mix(hashes, 51), mix(pairs[inside], 52)])
    return (every % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, row[:-1][inside] if len(row) else row])


def _counts(docs: DataFrame) -> np.ndarray:
    """(2, BUCKETS): n-grams of all rows and of those marked ``target``.  One vector leaves each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in frames(batches):
            bucket, row = buckets(list(batch["text"]))
            good = batch["target"].to_numpy(bool)[row]
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[good], minlength=BUCKETS)
        held = np.flatnonzero(total[0])
        yield pd.DataFrame({"bucket": held, "every": total[0, held], "good": total[1, held]})

    rows = (
        docs.select("text", "target").mapInPandas(run, "bucket long, every long, good long")
        .groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("good").alias("good")).collect()
    )
    out = np.zeros((2, BUCKETS))
    for r in rows:
        out[:, r["bucket"]] = r["every"], r["good"]
    return out


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, log_ratio, draw, place and kept of every row of ``docs``.

    The target model is counted on all documents labelled of quality 1; the
    raw model and all draws cover every row.
    ``k`` documents are kept, by default the labels' share of quality 1 times
    the number of rows.  Without labels the ratio is 0 and all are kept.  A
    text that is null or empty has ratio 0.  The noise depends on the id, the text's
    hash and the seed only, so reruns agree; ``place`` counts from 0, and ties
    go by id.  Other columns are not read.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id", F.lit(True).alias("target")).distinct()
    narrow = docs.select("doc_id", "text")
    # The ids grow with the input: never broadcast, also where they are few, so that all sizes run alike.
    # Null ids match nothing; the salt keeps them from landing in one task.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    marked = narrow.withColumn("__salt", salt).join(
        good.withColumn("__salt", F.lit(0).cast("long")).hint("merge"), ["doc_id", "__salt"], "left")
    counts = _counts(marked.withColumn("target", F.coalesce("target", F.lit(False))))
    share = labels.filter("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    smooth = counts + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum()) if counts[1].any() else np.zeros(BUCKETS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            bucket, row = buckets(list(batch["text"]))
            total = np.bincount(row, ratio[bucket], minlength=len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "log_ratio": total, "noise": batch["noise"].array})

    # 52 bits of the hash as a number strictly between 0 and 1.
    even = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))), 12) + 0.5) / float(2**52)
    scored = narrow.withColumn("noise", -F.log(-F.log(even))).mapInPandas(run, "doc_id long, log_ratio double, noise double")
    staged = Staged(scored.withColumn("draw", F.col("log_ratio") + F.col("noise")).drop("noise"), "draws")
    if k is None:
        k = round((1.0 if share is None else share) * staged.df.count())
    placed = with_ordinal(staged.df.withColumn("__down", -F.col("draw")), "__down", "doc_id", name="place")
    return placed.drop("__down").withColumn("kept", F.col("place") < k)

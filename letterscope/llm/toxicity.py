"""Toxicity categories by a chain of linear classifiers.

Cues are words and beginnings of words that occur far more often in documents
labelled toxic; they are found by a likelihood-ratio test that allows for the
number of candidates.  The chain predicts one category after the other.  Each
model sees the cues and the probabilities of the categories before it; when it
is fitted, those come from models that did not see the row (out of fold).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterscope.llm.common import Staged, labelled_rows
from letterscope.llm.linear import fit, sigmoid
from letterscope.llm.textvec import BYTE_VALUES, LOWER, PUNCTUATION, frames, laid_out, mix, slice_hashes, word_places

PER_CLASS, MOST_CUES, FOLDS, STEPS = 4000, 4096, 3, 300
PREFIXES = (4, 5, 6, 7)
# The chain.  The labels table has one flag, so the later categories are its
# documents that repeat cues, and those in which cues are dense.
CATEGORIES = ("toxic", "repeated", "dense")
REPEATED, DENSE = 3, 0.02


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of their first 4 to 7 bytes, each one's text, and the number of words of each text.

    Words are runs of letters, digits and non-ASCII characters, A-Z lowered.
    """
    raw, borders = laid_out(texts)
    raw = LOWER[raw]
    starts, ends = word_places(raw, PUNCTUATION)
    row = np.searchsorted(borders, starts, side="right") - 1
    found, rows = [mix(slice_hashes(raw, BYTE_VALUES, starts, ends)[0], 61)], [row]
    for k in PREFIXES:
        longer = ends - starts > k
        found.append(mix(slice_hashes(raw, BYTE_VALUES, starts[longer], starts[longer] + k)[0], 61 + k))
        rows.append(row[longer])
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def _g2(bad: Column, good: Column, all_bad: int, all_good: int) -> Column:
    """Log-likelihood ratio of a cue's document counts in both classes."""
    share = (bad + good) / F.lit(float(all_bad + all_good))

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(F.lit(0.0))

    return 2 * (part(bad, share * all_bad) + part(good, share * all_good)
                + part(all_bad - bad, (1 - share) * all_bad) + part(all_good - good, (1 - share) * all_good))


def find_cues(sample: DataFrame, all_bad: int, all_good: int) -> np.ndarray:
    """At most ``MOST_CUES`` hashes, strongest first, from a bounded sample (text, label)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            found, row, _ = features(list(batch["text"]))
            label = batch["label"].to_numpy()
            order = np.lexsort((row, found))
            found, row = found[order], row[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
            found, bad = found[new], label[row[new]] == 1
            if len(found):
                cue, back = np.unique(found, return_inverse=True)
                yield pd.DataFrame({"cue": cue.view(np.int64), "bad": np.bincount(back, bad).astype(np.int64),
                                    "good": np.bincount(back, ~bad).astype(np.int64)})

    counted = Staged(
        sample.select("text", "label").mapInPandas(run, "cue long, bad long, good long")
        .groupBy("cue").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "cues")
    # Rarer ones cannot pass the test, so they need not be allowed for.
    candidates = max(1, counted.df.filter(F.col("bad") >= 4).count())
    bad, good = F.col("bad").cast("double"), F.col("good").cast("double")
    strength = _g2(bad, good, all_bad, all_good)
    least = 2 * np.log(20.0 * candidates)
    # Present in a toxic document at least five times as often as in another one.
    often = (bad + 0.5) / (all_bad + 1.0) >= 5 * (good + 0.5) / (all_good + 1.0)
    rows = counted.df.withColumn("g", strength).filter((F.col("g") >= least) & often).orderBy(F.desc("g"), "cue").limit(MOST_CUES).collect()
    counted.drop()
    return np.array([r["cue"] for r in rows], np.int64).view(np.uint64)


@dataclass
class Cues:
    """Sorted cue hashes; finds them in texts."""

    hashes: np.ndarray

    def hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, cue number) of all hits, and the number of words of each text."""
        found, row, n = features(texts)
        if not len(self.hashes):
            return np.zeros(0, int), np.zeros(0, int), n
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[at] == found
        return row[hit], at[hit], n

    def matrix(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Presence of every cue with two summary columns; number of hits; share of words."""
        row, cue, n = self.hits(texts)
        x = np.zeros((len(texts), len(self.hashes) + 2), np.float32)
        x[row, cue] = 1.0
        hits = np.bincount(row, minlength=len(texts))
        share = hits / np.maximum(1, n)
        x[:, -2], x[:, -1] = np.log1p(hits), np.minimum(1.0, 10.0 * share)
        return x, hits, share


class Chain:
    """One logistic model for each category; a later one has the earlier probabilities as columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray):
        self.models: list[tuple[np.ndarray, float]] = []
        earlier = np.zeros((len(x), 0), np.float32)
        for k in range(y.shape[1]):
            seen = np.concatenate([x, earlier], axis=1)
            sign = np.where(y[:, k], 1.0, -1.0).astype(np.float32)
            out = np.zeros(len(x), np.float32)
            for f in range(FOLDS):
                train, test = fold != f, fold == f
                if train.any() and test.any():
                    w, b = fit(seen[train], sign[train], "logistic", 1e-4, STEPS)
                    out[test] = sigmoid(seen[test] @ w + b)
            self.models.append(fit(seen, sign, "logistic", 1e-4, STEPS))
            earlier = np.concatenate([earlier, out[:, None]], axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        earlier = np.zeros((len(x), 0))
        for w, b in self.models:
            p = sigmoid(np.concatenate([x, earlier], axis=1) @ w + b)
            earlier = np.concatenate([earlier, p[:, None]], axis=1)
        return earlier


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Cues, Chain] | None:
    """Cues and chain from at most ``per_class`` labelled documents of each class, chosen by hash."""
    sample = Staged(labelled_rows(docs.select("doc_id", "text"), labels, "toxic", per_class, "text"), "toxic-sample")
    counts = {r["label"]: r["n"] for r in sample.df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        sample.drop()
        return None
    cues = Cues(np.sort(find_cues(sample.df, bad, good)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            row, cue, n = cues.hits(list(batch["text"]))
            order = np.argsort(row, kind="stable")
            at = np.searchsorted(row[order], np.arange(len(batch) + 1))
            yield pd.DataFrame({"label": batch["label"].array, "fold": batch["fold"].array, "words": n,
                                "cues": [cue[order][a:b] for a, b in zip(at[:-1], at[1:], strict=True)]})

    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    rows = sample.df.select("label", "text", fold, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").select("label", "text", "fold").mapInPandas(
        run, "label int, fold int, words long, cues array<int>").toPandas()
    sample.drop()
    x = np.zeros((len(rows), len(cues.hashes) + 2), np.float32)
    hits = np.array([len(c) for c in rows["cues"]])
    for i, c in enumerate(rows["cues"]):
        x[i, list(c)] = 1.0
    share = hits / np.maximum(1, rows["words"].to_numpy())
    x[:, -2], x[:, -1] = np.log1p(hits), np.minimum(1.0, 10.0 * share)
    toxic = rows["label"].to_numpy() == 1
    y = np.stack([toxic, toxic & (hits >= REPEATED), toxic & (share >= DENSE)], axis=1)
    return cues, Chain(x, y, rows["fold"].to_numpy())


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, at_least: float = 0.5) -> DataFrame:
    """doc_id, the probability of each category, n_cues and toxic of every row of ``docs``.

    ``toxic`` is true if the first category's probability reaches ``at_least``.
    A null or empty text has no cues and is judged as such.  Without labels of
    both classes all probabilities are 0.  Repeated rows and null ids come back
    as they are; other columns are not read.
    """
    trained = train(docs, labels, per_class)
    names = [f"p_{c}" for c in CATEGORIES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            if trained is None:
                p, hits = np.zeros((len(batch), len(names))), np.zeros(len(batch), int)
            else:
                x, hits, _ = trained[0].matrix(list(batch["text"]))
                p = trained[1].probabilities(x)
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, **dict(zip(names, p.T, strict=True)),
                                "n_cues": hits, "toxic": p[:, 0] >= at_least})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", n_cues long, toxic boolean")

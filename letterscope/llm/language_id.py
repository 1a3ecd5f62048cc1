"""Language of whole texts: first the family, then the languages of that family one against one.

Features are relative frequencies of hashed n-grams of lower-case UTF-8 bytes.
A linear support vector machine for each family tells the families apart; one
for each pair of languages within a family decides by vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letterscope.llm.common import labelled_rows
from letterscope.llm.linear import fit_among, sigmoid
from letterscope.llm.textvec import frames, laid_out

# Families of ISO 639-1 codes.  A code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af yi lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky",
    "iranian": "fa ku ps tg",
    "indic": "hi bn ur pa mr gu ne si",
    "semitic": "ar he am mt",
    "baltic": "lt lv",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
ORDERS, DIMENSIONS = (2, 3, 4), 4096
PER_LANGUAGE, MOST_ROWS, STEPS = 400, 4000, 40

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [b if chr(b).isalpha() else 0x20 for b in range(128)]


def grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """For each order the bucket of the n-gram at every byte, whether it counts, and the texts' borders.

    ASCII characters that are no letters count as blanks; an n-gram that would
    cross into the next text or is all blank does not count.
    """
    raw, borders = laid_out([t.lower() if t else t for t in texts])
    raw = _FOLD[raw].astype(np.uint32)
    left = np.repeat(borders[1:], np.diff(borders)) - np.arange(len(raw)) - 1
    buckets, counted = [], []
    for order in ORDERS:
        value = np.full(len(raw), order, np.uint32)
        blank = np.ones(len(raw), bool)
        for k in range(order):
            shifted = np.roll(raw, -k)
            with np.errstate(over="ignore"):
                value = (value ^ shifted) * np.uint32(0x9E3779B1)
                value ^= value >> np.uint32(15)
            blank &= shifted == 0x20
        buckets.append((value % np.uint32(DIMENSIONS)).astype(np.int64))
        counted.append((left >= order) & ~blank)
    return buckets, borders, counted


def frequencies(texts: list[str]) -> np.ndarray:
    """Dense features of a bounded sample."""
    out = np.zeros((len(texts), len(ORDERS) * DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        buckets, _, counted = grams([text])
        for k, (b, c) in enumerate(zip(buckets, counted, strict=True)):
            n = np.bincount(b[c], minlength=DIMENSIONS)
            out[i, k * DIMENSIONS : (k + 1) * DIMENSIONS] = n / max(1, n.sum())
    return out


class Model:
    """Weights of all machines side by side: the families first, then the pairs."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        """``x``: the frequencies of each text; changed in place."""
        self.languages = sorted(set(languages))
        family = [FAMILY_OF.get(code, code) for code in languages]
        self.families = sorted(set(family))
        self.members = {f: [c for c in self.languages if FAMILY_OF.get(c, c) == f] for f in self.families}
        self.pairs = [p for f in self.families for p in combinations(self.members[f], 2)]
        mean = x.mean(axis=0)
        x -= mean
        spread = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x))
        scale = 1.0 / (spread + np.float32(2e-4))
        x *= scale / np.float32(np.sqrt(x.shape[1]))
        columns, offsets = [], []
        own, family = np.array(languages), np.array(family)
        tasks = [(family == f, np.ones(len(own), bool)) for f in self.families if len(self.families) > 1]
        tasks += [(own == a, (own == a) | (own == b)) for a, b in self.pairs]
        for positive, among in tasks:
            w, b = fit_among(x, np.where(positive, 1.0, -1.0).astype(np.float32), among, 1e-3, STEPS)
            w = w * scale / np.sqrt(x.shape[1])
            columns.append(w)
            offsets.append(b - float(w @ mean))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((x.shape[1], 0))
        self.offsets = np.array(offsets)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        buckets, borders, counted = grams(texts)
        out = np.tile(self.offsets, (len(texts), 1))
        for k, (b, c) in enumerate(zip(buckets, counted, strict=True)):
            weights = self.weights[k * DIMENSIONS : (k + 1) * DIMENSIONS]
            n = np.add.reduceat(c, borders[:-1], dtype=np.int64)
            for m in range(weights.shape[1]):
                total = np.add.reduceat(np.where(c, weights[b, m], 0.0), borders[:-1])
                out[:, m] += total / np.maximum(1, n)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and a score from 0 to 1: the family's share times the language's mean share of its duels."""
        margins = self.margins(texts)
        several = len(self.families) if len(self.families) > 1 else 0
        if several:
            shares = sigmoid(2.0 * margins[:, :several])
            best = margins[:, :several].argmax(axis=1)
            certainty = shares[np.arange(len(texts)), best] / shares.sum(axis=1)
        else:
            best, certainty = np.zeros(len(texts), int), np.ones(len(texts))
        chosen = np.empty(len(texts), object)
        score = np.zeros(len(texts))
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            codes = self.members[family]
            wins, sums = np.zeros((2, len(rows), len(codes)))
            for m, (a, b) in enumerate(self.pairs, several):
                if a in codes:
                    share = sigmoid(2.0 * margins[rows, m])
                    for code, part in ((a, share), (b, 1.0 - share)):
                        wins[:, codes.index(code)] += part > 0.5
                        sums[:, codes.index(code)] += part
            # Most duels won; among equals the larger share, then the first by name.
            first = (wins + sums / (len(codes) + 1.0)).argmax(axis=1)
            chosen[rows] = np.array(codes, object)[first]
            duels = max(1, len(codes) - 1)
            own = sums[np.arange(len(rows)), first] / duels if len(codes) > 1 else np.ones(len(rows))
            score[rows] = certainty[rows] * own
        return list(chosen), np.clip(score, 0.0, 1.0)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model | None:
    """A model from at most ``per_language`` documents of each language and ``most_rows`` in all, chosen by hash.

    Where the second limit binds, all languages give equally many as far as
    they have them, so none is left out as long as ``most_rows`` is at least
    their number.  An id that stands for several languages learns one of them,
    the last by name.  The driver holds one matrix of the sample, at most
    ``most_rows`` times the number of features in single precision.
    """
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    rows = labelled_rows(usable.select("doc_id", "text"), usable.select("doc_id", "lang"), "lang", per_language, "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            own = [frequencies([text])[0] for text in batch["text"]]
            held = [np.flatnonzero(x).astype(np.int32) for x in own]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "label": batch["label"].array, "held": held,
                                "share": [x[at] for x, at in zip(own, held, strict=True)]})

    # Texts stay on the executors; a document's vector is bounded, whatever its length.
    vectors = rows.mapInPandas(run, "doc_id long, label string, held array<int>, share array<float>")
    # At most ``per_language`` rows in each window.
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    table = vectors.withColumn("rank", rank).orderBy("rank", "label").limit(most_rows).select("label", "held", "share").toArrow()
    if not table.num_rows:
        return None
    languages = table.column("label").to_pylist()
    x = np.zeros((table.num_rows, len(ORDERS) * DIMENSIONS), np.float32)
    row = 0
    for batch in table.to_batches():
        held, share = batch.column("held"), batch.column("share")
        size = np.diff(held.offsets.to_numpy())
        x[row + np.repeat(np.arange(len(size)), size), held.flatten().to_numpy()] = share.flatten().to_numpy()
        row += len(size)
    del table, batch, held, share
    return Model(x, languages)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    A document is held out if crc32 of its id as text is divisible by 5; the
    model learns from the others' text and language only.  A text that is null
    or has no letter is ``und`` with score 0, as is every text if there is
    nothing to learn from.  A null id is not held out and never learned from.
    Repeated rows come back as they are; other columns are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    marked = docs.withColumn("held_out", held_out)
    model = train(marked.filter(~F.col("held_out") & F.col("doc_id").isNotNull()), per_language)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            texts = list(batch["text"])
            if model is None:
                found, score = ["und"] * len(texts), np.zeros(len(texts))
            else:
                found, score = model.predict(texts)
            none = ~batch["letters"].to_numpy(bool)
            score = np.where(none, 0.0, score)
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "held_out": batch["held_out"].array,
                                "lang_pred": ["und" if n else f for n, f in zip(none, found, strict=True)], "score": score})

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return marked.select("doc_id", "held_out", "text", letters).mapInPandas(
        run, "doc_id long, held_out boolean, lang_pred string, score double")

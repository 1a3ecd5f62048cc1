"""Alignment of two tokenizers' tokens over the same bytes by galloping intersection.

Both tokenizers' tokens end at ascending byte offsets.  The shorter list of
ends of a document drives a search into the longer one: from a first guess it
doubles its step until the offset is enclosed, then halves the interval.  An
offset found in both lists ends a group; the rank of an offset in the longer
list, less the rank of the one before, is the range of tokens that overlap.

Both tokenizers encode each distinct unit of text once while it is remembered:
a unit begins at the text's start or at a lone blank between visible
characters, where neither tokenizer can have a token on both sides.  Units only
save time; searches run over the ends of whole documents.

Pairs of token ids are counted over the corpus as documents that hold them.
Documents are worked through in blocks of bounded size; what moves is one count
for each distinct pair of a block, and back comes its total.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from letterscope.llm.common import Staged
from letterscope.llm.pretokens import SPACE, Encoder, _tables
from letterscope.llm.textvec import chunks, slice_hashes
from letterscope.llm.token_counts import _byte_names

BLOCK = 8 << 20


def units(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of blank + text: (joined text, starts, ends, hashes, second hashes, first unit of each text).

    ``texts`` are not empty.
    """
    joined = "".join(f" {t}" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kinds, values = _tables()
    visible = kinds[points] != SPACE
    mark = points == 0x20
    mark[1:] &= visible[:-1]
    mark[:-1] &= visible[1:]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    mark[begins[1:] - 1] &= False  # a text's last blank stays with what it follows
    mark[begins[:-1]] = True
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], len(points))
    hashes, checks = slice_hashes(points, values, starts, ends, checks=True)
    return joined, starts, ends, hashes, checks, np.searchsorted(starts, begins)


class Pool:
    """Runs of numbers end to end, growing by doubling."""

    def __init__(self):
        self.data, self.used = np.empty(1 << 16, np.int32), 0

    def add(self, run: list[int]) -> int:
        need = self.used + len(run)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(need, len(self.data)), np.int32)])
        self.data[self.used : need] = run
        self.used = need
        return need - len(run)


class Units:
    """Both tokenizers' ids of each remembered unit."""

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        self.a = Tokenizer.from_file(public_tokenizers.path(byte_vocabulary))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_vocabulary))
        value = {name: b for b, name in enumerate(_byte_names())}
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t in map(self.a.id_to_token, range(size))]
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as text with what follows: another id of the run, the other tokenizer's run, the next group.
        self.texts = ([f"{i}," for i in range(size)] + [f"{i}|" for i in range(size)]
                      + [f"{i}," for i, _ in pieces] + [f"{i};" for i, _ in pieces])
        self.encoder = Encoder(self._encode, None, self._empty, bits=20)
        self._empty()

    def _empty(self) -> None:
        self.pools, self.places = (Pool(), Pool()), Pool()

    def _encode(self, found: list[str]) -> np.ndarray:
        out = np.empty(len(found), np.int64)
        first = [e.ids for e in self.a.encode_batch(found, add_special_tokens=False)]
        second = self.b.encode([u[1:] for u in found], num_threads=1)  # it adds the leading blank itself
        for k, (unit, a, b) in enumerate(zip(found, first, second, strict=True)):
            raw = unit.encode("utf-8", "surrogatepass")
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            if not same:
                a = b = []
            out[k] = self.places.add([self.pools[0].add(a), len(a), self.pools[1].add(b), len(b)]) >> 2
        return out

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers end to end, and where each text's ids begin; none for a text whose bytes differ."""
        joined, starts, ends, hashes, checks, first = units(texts)
        number = self.encoder.looked_up(joined, starts, ends, hashes, checks)
        place = self.places.data[: self.places.used].reshape(-1, 4)[number].astype(np.int64)
        whole = np.logical_and.reduceat(place[:, 1] > 0, first[:-1])
        place[~np.repeat(whole, np.diff(first)), 1::2] = 0
        ids, begins = [], []
        for side in (0, 1):
            at, n = place[:, 2 * side], place[:, 2 * side + 1]
            end = np.append(0, np.cumsum(n))
            ids.append(self.pools[side].data[np.repeat(at - end[:-1], n) + np.arange(end[-1])])
            begins.append(end[first])
        return ids, begins


@cache
def units_of(byte_vocabulary: str, piece_vocabulary: str) -> Units:
    """One for each Python worker."""
    return Units(byte_vocabulary, piece_vocabulary)


def gallop(sought: np.ndarray, held: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each ``sought`` offset the first place in ``held[low:high]`` that is not below it.

    ``held`` ascends between each ``low`` and ``high``, and its last offset there
    is not below the sought one.  All searches advance together: from ``guess``
    with steps of 1, 2, 4, ..., then by halving.
    """
    under, over = low - 1, high - 1  # held[under] < sought <= held[over]
    below = held[guess] < sought
    under, over = np.where(below, guess, under), np.where(below, over, guess)
    step = 1
    upward, downward = np.flatnonzero(below), np.flatnonzero(~below)
    while len(upward) or len(downward):
        at = np.minimum(under[upward] + step, over[upward])
        less = held[at] < sought[upward]
        over[upward[~less]] = at[~less]
        under[upward[less]] = at[less]
        upward = upward[less]
        at = np.maximum(over[downward] - step, under[downward])
        inside = at > under[downward]
        less = inside & (held[np.maximum(at, 0)] < sought[downward])
        under[downward[less]] = at[less]
        on = inside & ~less
        over[downward[on]] = at[on]
        downward = downward[on]
        step *= 2
    left = np.flatnonzero(over - under > 1)
    while len(left):
        middle = (under[left] + over[left]) >> 1
        less = held[middle] < sought[left]
        under[left[less]], over[left[~less]] = middle[less], middle[~less]
        left = left[over[left] - under[left] > 1]
    return over


class Aligned:
    """Alignment of some documents: token ids of both sides, groups and links."""

    def __init__(self, known: Units, texts: list[str]):
        (self.a, self.b), (self.first_a, self.first_b) = known.of(texts)
        self.known = known
        n_a, n_b = np.diff(self.first_a), np.diff(self.first_b)
        self.n_a, self.n_b = n_a, n_b
        shift = len(self.a)
        ends = np.concatenate([np.cumsum(known.a_length[self.a]), np.cumsum(known.b_length[self.b])])
        # The side with fewer tokens, then the other one, as places in ``ends``.
        drives_a = n_a <= n_b
        short = np.where(drives_a, self.first_a[:-1], shift + self.first_b[:-1])
        long = np.where(drives_a, shift + self.first_b[:-1], self.first_a[:-1])
        n_short, n_long = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
        begins = np.append(0, np.cumsum(n_short))
        doc = np.repeat(np.arange(len(texts)), n_short)
        rank = np.arange(begins[-1]) - begins[doc]
        driving = short[doc] + rank
        sought, low = ends[driving], long[doc]
        found = gallop(sought, ends, low, low + n_long[doc], low + rank * n_long[doc] // n_short[doc])
        common = ends[found] == sought
        # A token overlaps from the first one that ends after its begin to the one that holds its last byte.
        after = found + common
        start = np.append(0, after[:-1])
        start[begins[:-1][n_short > 0]] = long[n_short > 0]
        n = found - start + 1
        total = np.append(0, np.cumsum(n))
        driver = np.repeat(driving, n)
        other = np.arange(total[-1]) + np.repeat(start - total[:-1], n)
        by_a = np.repeat(drives_a[doc], n)
        every = np.concatenate([self.a, self.b]).astype(np.int64)
        self.pairs = every[np.where(by_a, driver, other)] * len(known.b_bytes) + every[np.where(by_a, other, driver)]
        self.link_doc = np.repeat(doc, n)
        self.n_links = np.bincount(doc, n, len(texts)).astype(np.int64)
        self.n_groups = np.bincount(doc, common, len(texts)).astype(np.int64)
        a_side = drives_a[doc[common]]
        self.group_ends = (np.where(a_side, driving[common], found[common]), np.where(a_side, found[common], driving[common]) - shift)

    def group_texts(self) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document: decimal ids in order."""
        size_a, size_b = len(self.known.a_bytes), len(self.known.b_bytes)
        last_a, last_b = self.group_ends
        name_a, name_b = self.a.astype(np.int64), self.b.astype(np.int64) + 2 * size_a
        name_a[last_a] += size_a
        name_b[last_b] += size_b
        group_a, group_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        group_a[last_a[:-1] + 1] = 1
        group_b[last_b[:-1] + 1] = 1
        before_b = np.append(0, last_b[:-1] + 1)[np.cumsum(group_a)] if len(self.a) else group_a
        before_a = (last_a + 1)[np.cumsum(group_b)] if len(self.b) else group_b
        names = np.empty(len(self.a) + len(self.b), np.int64)
        names[np.arange(len(self.a)) + before_b] = name_a
        names[np.arange(len(self.b)) + before_a] = name_b
        first, texts = self.first_a + self.first_b, self.known.texts
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield "".join(map(texts.__getitem__, names[a:b].tolist()))[:-1]


def _blocks(batches: Iterator[pd.DataFrame], size: int = BLOCK) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows gathered across batches to about ``size`` characters."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            if held and held + len(text or "") > size:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(None if pd.isna(doc_id) else int(doc_id))
            texts.append(text or "")
            held += len(text or "") + 100
    if ids:
        yield ids, texts


def _aligned(known: Units, texts: list[str]) -> Iterator[tuple[np.ndarray, Aligned]]:
    """Places of the texts that are not empty, and their alignment, in parts that fit a cache."""
    places = np.array([i for i, t in enumerate(texts) if t], np.int64)
    for low, high in chunks([texts[i] for i in places]):
        yield places[low:high], Aligned(known, [texts[i] for i in places[low:high]])


_BLOCK_SCHEMA = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "links binary, pairs array<long>, holders array<long>")


def _linked(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str) -> DataFrame:
    """A row for each document, then one for its block: the block's distinct pairs and how many documents hold each.

    ``links`` of a document: places of its distinct pairs in the block's list, then how often it has each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = units_of(byte_vocabulary, piece_vocabulary)
        base = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_blocks(batches)):
            counts = np.zeros((4, len(ids)), np.int64)
            hashes, held = [""] * len(ids), []
            for places, found in _aligned(known, texts):
                counts[:, places] = found.n_a, found.n_b, found.n_groups, found.n_links
                for i, text in zip(places, found.group_texts(), strict=True):
                    hashes[i] = hashlib.sha256(text.encode()).hexdigest() if text else ""
                rows = places[found.link_doc] * (len(known.a_bytes) * len(known.b_bytes)) + found.pairs
                held.append(np.stack(np.unique(rows, return_counts=True)))
            own, times = np.concatenate(held, axis=1) if held else np.zeros((2, 0), np.int64)
            doc, pair = np.divmod(own, len(known.a_bytes) * len(known.b_bytes))
            pairs, local, holders = np.unique(pair, return_inverse=True, return_counts=True)
            order = np.argsort(doc, kind="stable")
            at = np.searchsorted(doc[order], np.arange(len(ids) + 1))
            local, times = local[order].astype("<u4"), times[order].astype("<u4")
            links = [zlib.compress(local[a:b].tobytes() + times[a:b].tobytes(), 1) for a, b in zip(at[:-1], at[1:], strict=True)]
            none = [None] * len(ids)
            yield pd.DataFrame({"block": base + number, "doc_id": pd.array(ids, "Int64"), "n_a": counts[0], "n_b": counts[1],
                                "n_groups": counts[2], "n_links": counts[3], "groups_sha256": hashes, "links": links,
                                "pairs": none, "holders": none})
            yield pd.DataFrame({"block": [base + number], "doc_id": pd.array([None], "Int64"), "n_a": 0, "n_b": 0, "n_groups": 0,
                                "n_links": 0, "groups_sha256": None, "links": None, "pairs": [pairs], "holders": [holders]})

    return docs.select("doc_id", "text").mapInPandas(run, _BLOCK_SCHEMA)


_DOC_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _valued(key: tuple, rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block with the corpus-wide counts of their links."""
    values = values.sort_values("pair")
    n, best = values["n"].to_numpy(np.int64), values["best"].to_numpy(bool)
    n_best, count_sum = [], []
    for packed in rows["links"]:
        local, times = np.frombuffer(zlib.decompress(packed), "<u4").reshape(2, -1).astype(np.int64)
        n_best.append(int(times[best[local]].sum()))
        count_sum.append(int((times * n[local]).sum()))
    return rows.assign(n_best=n_best, count_sum=count_sum)[[c.split(" ")[0] for c in _DOC_SCHEMA.split(", ")]]


def align(docs: DataFrame, byte_vocabulary: str = "byte_bpe_50k.json", piece_vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """Counts of every document's alignment: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Tokens are those of blank + text, special strings read as plain text.  A
    text that is null or empty, or whose tokens' bytes differ from it, has none:
    zeros and an empty string.  An id pair counts once for each row that links
    it; ``n_best`` are links of pairs with the highest count of their first id,
    ties included.  Repeated rows and null ids come back as they are; other
    columns are not read.  An empty table gives no rows.
    """
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_vocabulary)).get_piece_size()
    staged = Staged(_linked(docs, byte_vocabulary, piece_vocabulary), "aligned").df
    held = (
        staged.filter(F.col("pairs").isNotNull())
        .select("block", F.explode(F.arrays_zip("pairs", "holders")).alias("held"))
        .select("block", F.col("held.pairs").alias("pair"), F.col("held.holders").alias("n"))
    )
    totals = Staged(held.groupBy("pair").agg(F.sum("n").alias("n"))
                    .withColumn("a", (F.col("pair") / pieces).cast("long")), "pairs").df
    highest = totals.groupBy("a").agg(F.max("n").alias("most"))
    valued = totals.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    back = held.select(F.col("block").alias("of"), "pair").join(valued.hint("merge"), "pair")
    rows = staged.filter(F.col("pairs").isNull()).drop("pairs", "holders")
    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInPandas(_valued, _DOC_SCHEMA)


def groups(docs: DataFrame, byte_vocabulary: str = "byte_bpe_50k.json", piece_vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, groups) of every row: ids of both tokenizers as ``a1,a2|b1;a3|b2,b3``, empty where there are no tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = units_of(byte_vocabulary, piece_vocabulary)
        for ids, texts in _blocks(batches):
            out = [""] * len(ids)
            for places, found in _aligned(known, texts):
                for i, text in zip(places, found.group_texts(), strict=True):
                    out[i] = text
            yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "groups": out})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, groups string")

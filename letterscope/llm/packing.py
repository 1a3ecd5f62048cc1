"""Vector bin packing of token sequences by the dot-product heuristic.

An item is a run of one document's ids with three sizes: tokens, segments
(always one) and loss-bearing tokens.  A sequence has a limit on each.  An item
goes to the open sequence that takes it whole and whose free room has the
largest dot product with it; if none takes it whole, it is cut to fill one.
Every task packs the documents it reads, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from letterscope.llm.pretokens import Encoder
from letterscope.llm.textvec import frames
from letterscope.llm.token_counts import _byte_names

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long, sequence_length long")


class Ids:
    """Ids of whole texts: the tokenizer encodes each distinct piece, the rest is look-up."""

    def __init__(self, vocabulary: str, special: str):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        model, names = tokenizer.model, {b: ord(n) for b, n in enumerate(_byte_names())}
        self.special = [tokenizer.token_to_id(special)]

        def encode(pieces: list[str]) -> np.ndarray:
            out = np.empty(len(pieces), np.int64)
            for k, piece in enumerate(pieces):
                if piece == special:
                    ids = self.special
                else:
                    raw = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(names)
                    ids = [t.id for t in model.tokenize(raw)]
                out[k] = self._keep(ids)
            return out

        self.encoder = Encoder(encode, special, self._empty, bits=21)
        self._empty()

    def _empty(self) -> None:
        # The pool is emptied with the memory of pieces; places of pieces
        # being encoded right now are counted from the new beginning.
        self.pool, self.used = np.empty(1 << 20, np.uint32), 0

    def _keep(self, ids: list[int]) -> int:
        n = len(ids)
        if self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(max(n, len(self.pool)), np.uint32)])
        self.pool[self.used : self.used + n] = ids
        self.used += n
        return (self.used - n) << 28 | n

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        places, first = self.encoder.values(texts)
        at, n = places >> 28, places & ((1 << 28) - 1)
        ends = np.append(0, np.cumsum(n))
        flat = self.pool[np.repeat(at - ends[:-1], n) + np.arange(ends[-1])]
        return [flat[ends[a] : ends[b]] for a, b in zip(first[:-1], first[1:], strict=True)]


@cache
def ids_of(vocabulary: str, special: str) -> Ids:
    """One for each Python worker."""
    return Ids(vocabulary, special)


@dataclass
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss: int = 2047


class Packer:
    """Open sequences of one task: at most ``width`` at a time, as arrays of free room.

    ``pieces`` are (row, start, length, crc, doc_tokens, loss, ids) tuples.
    """

    def __init__(self, limits: Limits, width: int = 128):
        self.limits = limits
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.room = np.tile(self.cap, (width, 1))
        self.held: list[list] = [[] for _ in range(width)]
        self.done: list[list] = []

    def place(self, item: tuple) -> None:
        """``item``: (doc_id, start, ids, doc_tokens, first loss-bearing id)."""
        while True:
            size = np.array([len(item[2]), 1, loss_of(item[1], len(item[2]), item[4])], float)
            fits = (self.room >= size).all(axis=1)
            if fits.any():
                score = np.where(fits, self.room @ (size / self.cap**2), -1.0)
                self._put(int(np.argmax(score)), item, size)
                return
            # Nowhere whole: fill the sequence with the most free tokens, keep the rest.
            able = (self.room[:, 1] >= 1) & (self.room[:, 0] >= 1)
            k = int(np.argmax(np.where(able, self.room[:, 0], -1.0)))
            n = min(int(self.room[k, 0]), len(item[2]))
            spare = int(self.room[k, 2])
            if loss_of(item[1], n, item[4]) > spare:
                # One id bears no loss at a piece's start; ids before the first loss-bearing one bear none.
                n = max(spare + 1, item[4] - item[1] + spare)
            if not able[k] or n < 1 or n >= len(item[2]):
                self._close(int(np.argmin(self.room[:, 0])))
                continue
            head = (item[0], item[1], item[2][:n], item[3], item[4])
            self._put(k, head, np.array([n, 1, loss_of(item[1], n, item[4])], float))
            item = (item[0], item[1] + n, item[2][n:], item[3], item[4])

    def _put(self, k: int, item: tuple, size: np.ndarray) -> None:
        self.held[k].append(item)
        self.room[k] -= size
        if self.room[k, 0] < 1 or self.room[k, 1] < 1:
            self._close(k)

    def _close(self, k: int) -> None:
        if self.held[k]:
            self.done.append(self.held[k])
        self.held[k], self.room[k] = [], self.cap

    def finish(self) -> None:
        """Close all: what is left open becomes full sequences and a rest cut at powers of two.

        Sequences whose length is a power of two need no padding.
        """
        left = [item for held in self.held for item in held]
        self.held = [[] for _ in self.held]
        self.room[:] = self.cap
        current: list = []
        spare = self.cap.copy()
        remaining = sum(len(i[2]) for i in left)
        target = self._target(remaining)
        for item in left:
            while item is not None:
                n = min(len(item[2]), target - int(self.cap[0] - spare[0]))
                loss = loss_of(item[1], n, item[4])
                if spare[1] < 1 or loss > spare[2]:
                    self.done.append(current)
                    current, spare = [], self.cap.copy()
                    target = self._target(remaining)
                    if loss > spare[2]:
                        n = max(1, int(spare[2]) + 1)
                    else:
                        continue
                head, rest = (item[0], item[1], item[2][:n], item[3], item[4]), None
                if n < len(item[2]):
                    rest = (item[0], item[1] + n, item[2][n:], item[3], item[4])
                current.append(head)
                spare -= np.array([n, 1, loss_of(head[1], n, head[4])], float)
                remaining -= n
                item = rest
                if self.cap[0] - spare[0] >= target:
                    self.done.append(current)
                    current, spare = [], self.cap.copy()
                    target = self._target(remaining)
        if current:
            self.done.append(current)

    def _target(self, remaining: int) -> int:
        if remaining >= self.limits.tokens:
            return self.limits.tokens
        return 1 << (remaining.bit_length() - 1) if remaining else 1


def loss_of(start: int, length: int, first: int) -> int:
    """Loss-bearing ids of a piece: from ``first`` on, but never the piece's own first id."""
    return max(0, start + length - max(first, start + 1))


def pack(docs: DataFrame, limits: Limits | None = None, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1,
         special: str = "<|endoftext|>", prompt_chars: str | None = None, buffer: int = 2048) -> DataFrame:
    """One row for each piece of every row of ``docs``; each id lies in exactly one piece.

    A document is the ids of its whole text (null: none) and then ``end_id``;
    repeated rows are packed once each.  The first id of a document bears no
    loss; with ``prompt_chars`` (an integer column) neither do the ids of that
    many leading characters, a null counting as 0.  The vector is the number of ids, one
    segment, and the loss-bearing ids.  Other columns are not read; an empty
    table gives no rows.  ``sequence_length`` is the number of real ids of the
    piece's sequence: padded to ``limits.tokens`` unless a power of two.

    Items wait in a buffer of at most ``buffer`` and are placed from large to
    small.  A task's result depends on its input split only, so a lost one
    gives the same sequences when it runs again.
    """
    limits = limits or Limits()
    prompt = F.col(prompt_chars).cast("int") if prompt_chars else F.lit(0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = ids_of(vocabulary, special)
        packer, waiting = Packer(limits), []
        base, count = TaskContext.get().partitionId() << 40, 0
        whole = min(limits.tokens, limits.loss + 1)

        def flush(last: bool) -> pd.DataFrame:
            nonlocal count
            waiting.sort(key=lambda item: -len(item[2]))
            for item in waiting:
                packer.place(item)
            waiting.clear()
            if last:
                packer.finish()
            rows = []
            for sequence in packer.done:
                at, total = 0, sum(len(item[2]) for item in sequence)
                for doc_id, start, part, n, first in sequence:
                    rows.append((doc_id, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), n,
                                 base + count, at, loss_of(start, len(part), first), total))
                    at += len(part)
                count += 1
            packer.done = []
            names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
            return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

        for batch in frames(batches):
            texts = list(batch["text"])
            heads = [t[: int(p)] if t and p == p and p > 0 else None for t, p in zip(texts, batch["prompt"], strict=True)]
            prompts = [len(x) for x in ids.of(heads)] if any(heads) else [0] * len(texts)
            doc_ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            for doc_id, part, prompt_ids in zip(doc_ids, ids.of(texts), prompts, strict=True):
                part = np.append(part, np.uint32(end_id))
                first = max(1, prompt_ids)
                full = (len(part) - 1) // whole * whole
                for start in range(0, full, whole):
                    piece = (doc_id, start, part[start : start + whole], len(part), first)
                    if whole == limits.tokens:
                        packer.done.append([piece])
                    else:
                        waiting.append(piece)
                waiting.append((doc_id, full, part[full:], len(part), first))
                if len(waiting) >= buffer:
                    yield flush(False)
        yield flush(True)

    return docs.select("doc_id", "text", prompt.alias("prompt")).mapInPandas(run, SCHEMA)

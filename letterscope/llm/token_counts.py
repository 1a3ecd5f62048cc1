"""Token counts by pair merging with a heap over a linked list.

Every piece starts as one symbol for each UTF-8 byte.  The heap holds adjacent
pairs that have a rank; the lowest rank, leftmost first, is popped and merged
in the linked list until no ranked pair is left.  The count is the number of
initial symbols minus the number of merges; no identifier is emitted.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from letterscope.llm.pretokens import Encoder
from letterscope.llm.textvec import frames


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in kept}
    names |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in names)}
    return [names[b] for b in range(256)]


class PairRanks:
    """The merge list of a vocabulary file, with symbols as numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        names: dict[str, int] = {}

        def number(name: str) -> int:
            return names.setdefault(name, len(names))

        self.bytes = [number(name) for name in _byte_names()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((number(left), number(right)), (rank, number(left + right)))

    def count(self, piece: str) -> int:
        """Symbols left of one piece."""
        symbols = [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        if n < 2:
            return n
        merges = self.merges
        heap = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merged = 0
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            merged += 1
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((made, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, made, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], made))
                if found:
                    heapq.heappush(heap, (found[0], h, symbols[h], made, found[1]))
        return n - merged


@cache
def counter(vocabulary: str, special: str) -> Encoder:
    """One for each Python worker; its memory of pieces outlives a task."""
    ranks = PairRanks(public_tokenizers.path(vocabulary))

    def encode(pieces: list[str]) -> np.ndarray:
        return np.fromiter((1 if p == special else ranks.count(p) for p in pieces), np.int64, len(pieces))

    return Encoder(encode, special)


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: str = "byte_bpe_50k.json",
                 special: str = "<|endoftext|>") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``, whole texts.

    A null text is empty: 0 bytes, 0 tokens.  Repeated rows and null ids come
    back as they are; other columns are not read.  The special string inside a
    text is one token, as the library takes it by default.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = counter(vocabulary, special)
        for batch in frames(batches):
            texts = list(batch["text"])
            values, first = encoder.values(texts)
            total = np.append(0, np.cumsum(values))
            n = total[first[1:]] - total[first[:-1]]
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "n_bytes": size, "n_tokens": n, "over_limit": n > limit})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

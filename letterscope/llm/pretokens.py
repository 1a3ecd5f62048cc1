"""Cutting whole texts into the pieces that byte-level pair merging works on.

The pieces are those of the published pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
They follow from where the class of character changes, so a batch of texts is
cut by a few passes over arrays.  What a piece costs to encode is remembered in
a table of bounded size; forgetting changes time, never results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np

from letterscope.llm.textvec import chunks, mix, slice_hashes

SPACE, LETTER, NUMBER, OTHER, BORDER, SPECIAL = range(6)
# Fixed value: the characters of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and hash value of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    kinds[[ord(c) for c in WHITE_SPACE]] = SPACE
    return kinds, mix(np.arange(0x110000, dtype=np.uint64), 11)


def cut(texts: list[str | None], special: str | None = None) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces of ``texts``: (joined text, starts, ends, hashes, second hashes, first piece of each text).

    ``special`` is a string that stands for one token wherever it occurs.
    """
    joined = "\n".join(t or "" for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kinds_of, values = _tables()
    kind = kinds_of[points]
    lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    borders = np.cumsum(lengths + 1) - 1
    kind[borders] = BORDER
    begins = []
    if special and special in joined:
        at = joined.find(special)
        while at >= 0:
            kind[at : at + len(special)] = SPECIAL
            begins.append(at)
            at = joined.find(special, at + len(special))
    mark = np.empty(len(kind), bool)
    mark[0] = True
    np.not_equal(kind[1:], kind[:-1], out=mark[1:])
    mark[begins] = True
    run = np.flatnonzero(mark)
    run_end = np.append(run[1:], len(kind))
    run_kind = kind[run]
    following = np.append(run_kind[1:], BORDER)
    # A white-space run before a visible one gives up its last character: a
    # blank joins what follows, any other character stands alone.
    gives = (run_kind == SPACE) & (following != BORDER) & (following != SPECIAL)
    blank = gives & (points[run_end - 1] == 0x20)
    mark[run_end[gives] - 1] = True
    mark[run_end[blank]] = False
    joined_on = np.append(False, blank[:-1])
    # An apostrophe on its own takes the letters of a contraction with it.
    alone = np.flatnonzero((run_kind == OTHER) & (following == LETTER) & ~joined_on & (run_end - run == 1) & (points[run] == 0x27))
    for i in alone:
        tail = joined[run_end[i] : run_end[i] + 2]
        take = 1 if tail[:1] in ("s", "t", "m", "d") else 2 if tail in ("re", "ve", "ll") else 0
        if take:
            mark[run_end[i]] = False
            mark[run_end[i] + take] = True
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], len(kind))
    wanted = kind[starts] != BORDER
    starts, ends = starts[wanted], ends[wanted]
    hashes, checks = slice_hashes(points, values, starts, ends, checks=True)
    return joined, starts, ends, hashes, checks, np.searchsorted(starts, np.append(0, borders + 1))


def distinct(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each pair (hash, check), and for every pair the number of its one."""
    _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    if np.array_equal(checks[at][back], checks):
        return at, back
    pairs = np.rec.fromarrays([hashes, checks])
    _, at, back = np.unique(pairs, return_index=True, return_inverse=True)
    return at, back


class Memory:
    """Open-addressing table from a piece's two hashes to a number; emptied when half full.

    Both hashes, 128 bits, are compared before a number is given back.
    """

    def __init__(self, bits: int = 22):
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.checks = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)
        self.held = 0

    def clear(self) -> None:
        self.keys.fill(0)
        self.held = 0

    def full(self, more: int) -> bool:
        return self.held + more > (self.mask + 1) // 2

    def get(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the positions of pieces that are not held."""
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        key = self.keys[slot]
        out = self.values[slot]
        absent = key == 0
        probing = np.flatnonzero(((key != hashes) | (self.checks[slot] != checks)) & ~absent)
        while len(probing):
            slot[probing] = (slot[probing] + 1) & self.mask
            at = slot[probing]
            key = self.keys[at]
            hit = (key == hashes[probing]) & (self.checks[at] == checks[probing])
            out[probing[hit]] = self.values[at[hit]]
            absent[probing[key == 0]] = True
            probing = probing[~hit & (key != 0)]
        return out, np.flatnonzero(absent)

    def put(self, hashes: np.ndarray, checks: np.ndarray, values: np.ndarray) -> None:
        """Store distinct pieces that are not held yet."""
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            chosen = free[first]
            self.keys[slot[chosen]] = hashes[chosen]
            self.checks[slot[chosen]] = checks[chosen]
            self.values[slot[chosen]] = values[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask
        self.held += len(hashes)


class Encoder:
    """Values of the pieces of texts, each distinct piece worked out once while remembered.

    ``encode`` turns a list of distinct pieces into their values; ``clear`` is
    called whenever the memory is emptied.
    """

    def __init__(self, encode: Callable[[list[str]], np.ndarray], special: str | None = None,
                 clear: Callable[[], None] | None = None, bits: int = 22):
        self.encode, self.special, self.forget, self.memory = encode, special, clear, Memory(bits)

    def values(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One value for each piece, and where each text's pieces begin."""
        joined, starts, ends, hashes, checks, first = cut(texts, self.special)
        return self.looked_up(joined, starts, ends, hashes, checks), first

    def looked_up(self, joined: str, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """One value for each piece ``joined[start:end]`` with the given hashes."""
        hashes = np.maximum(hashes, np.uint64(1))  # 0 marks a free slot
        out, missing = self.memory.get(hashes, checks)
        if len(missing):
            at, back = distinct(hashes[missing], checks[missing])
            if self.memory.full(len(at)):
                self.memory.clear()
                if self.forget:
                    self.forget()
                at, back = distinct(hashes, checks)
                values = self._encoded(joined, starts, ends, at)
                if not self.memory.full(len(at)):
                    self.memory.put(hashes[at], checks[at], values)
                return values[back]
            at = missing[at]
            values = self._encoded(joined, starts, ends, at)
            self.memory.put(hashes[at], checks[at], values)
            out[missing] = values[back]
        return out

    def _encoded(self, joined: str, starts: np.ndarray, ends: np.ndarray, which: np.ndarray) -> np.ndarray:
        return self.encode([joined[starts[i] : ends[i]] for i in which])


__all__ = ["Encoder", "chunks", "cut"]

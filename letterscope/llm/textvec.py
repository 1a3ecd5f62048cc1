"""Whole texts as numpy arrays of word hashes.

Many texts are laid end to end in one byte array, so that a batch costs a few
passes over arrays instead of a Python step per word.  Chunks of texts are
bounded by ``CHUNK`` bytes; a longer text makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

CHUNK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((seed * _MULTIPLIER + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 7)
_WINDOW = 1 << 17


def slice_hashes(codes: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 checks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every slice ``codes[start:end]``, wherever it stands; with ``checks`` a second, independent one.

    ``table`` has a random value for each code.  Slices ascend, are not empty
    and do not overlap.  Each element's value and its place in the slice go
    through two multiplications with a shift between before they are added up,
    so a sum over rearranged elements does not cancel as a polynomial's can.
    The work goes through windows of bounded size; a long slice spans several.
    """
    first, second = np.zeros(len(starts), np.uint64), np.zeros(len(starts) if checks else 0, np.uint64)
    a = 0
    for low in range(0, len(codes), _WINDOW):
        high = low + _WINDOW
        while a < len(ends) and ends[a] <= low:
            a += 1
        b = a + int(np.searchsorted(starts[a:], high))
        if a == b:
            continue
        begin, end = np.maximum(starts[a:b], low), np.minimum(ends[a:b], high)
        # Slices and the gaps between them in turn; sums over gaps are passed over.
        turns = np.stack([begin, end], axis=1).ravel()[:-1] - begin[0]
        place = np.arange(begin[0], end[-1]) - np.repeat(starts[a:b], np.diff(begin, append=end[-1]))
        with np.errstate(over="ignore"):
            z = table[codes[begin[0] : end[-1]]] + place.astype(np.uint64) * np.uint64(_MULTIPLIER)
            z *= np.uint64(0xD6E8FEB86659FD93)
            z ^= z >> np.uint64(32)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            first[a:b] += np.add.reduceat(z, turns)[::2]
            if checks:
                z ^= z >> np.uint64(29)
                z *= np.uint64(0x94D049BB133111EB)
                z ^= z >> np.uint64(31)
                second[a:b] += np.add.reduceat(z, turns)[::2]
        a = max(a, b - 1)
    with np.errstate(over="ignore"):
        size = (ends - starts).astype(np.uint64) * np.uint64(_MULTIPLIER)
        return mix(first + size, 3), second


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` characters each."""
    start = held = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n + 1
    if start < len(texts):
        yield start, len(texts)


# The bytes that separate words: blank and 0x09 to 0x0D.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# All ASCII characters but letters and digits; for words without punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def laid_out(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end with a line feed after each, and where each begins."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), np.cumsum([0, *(len(p) + 1 for p in parts)])


def word_places(raw: np.ndarray, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that separate nothing."""
    edge = np.flatnonzero(np.diff(~separates[raw], prepend=False))
    return edge[0::2], edge[1::2]


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` of the texts, A-Z lowered, and where each text's words begin.

    A null text has no words.  The second array has one more entry than there are texts.
    """
    raw, borders = laid_out(texts)
    raw = LOWER[raw]
    starts, ends = word_places(raw, _IS_SPACE)
    return slice_hashes(raw, BYTE_VALUES, starts, ends)[0], np.searchsorted(starts, borders)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbouring words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n]
    for k in range(1, width):
        with np.errstate(over="ignore"):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n], k)
    return out


def frames(batches: Iterator[pd.DataFrame], text: str = "text") -> Iterator[pd.DataFrame]:
    """Arrow batches cut to chunks of bounded text size."""
    for batch in batches:
        for start, end in chunks(list(batch[text])):
            yield batch.iloc[start:end]

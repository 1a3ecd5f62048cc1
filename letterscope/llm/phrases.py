"""Document fingerprints by locally consistent parsing.

A text's characters are cut into phrases again and again, each phrase standing
for one symbol of the next level, until one symbol is left.  On every level

1. a run of one symbol becomes a symbol of its own, so neighbours differ;
2. deterministic coin tossing labels each symbol with the lowest bit in which
   it differs from the one before, and that bit's value; four rounds bring any
   64-bit names down to six labels, neighbours still differing;
3. a phrase begins where a label is larger than both its neighbours; from one
   such place to the next are 2 to 10 symbols;
4. a phrase is named by a hash of its symbols.

Where phrases begin follows from a few symbols around, so equal passages get
equal names inside, wherever they stand; only names near their borders differ.
The name of the last level stands for the whole text.  A fingerprint is that
name and the ``SAMPLES`` least hashes of the names from ``LEVEL`` on; two of
them tell the share of names that both texts have.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letterscope.llm.textvec import frames, mix

LEVEL, SAMPLES = 2, 64
_WINDOW = 1 << 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _tossed(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit that differs, plus the own value of that bit."""
    apart = before ^ own
    place = np.bitwise_count((apart & (~apart + _ONE)) - _ONE)
    return (2 * place + ((own >> place.astype(np.uint64)) & _ONE).astype(np.uint8)).astype(np.uint8)


def _table(bits: int) -> np.ndarray:
    """Tosses of all pairs of labels below 2**bits; the row of equal ones is never asked for."""
    n = 1 << bits
    values = np.arange(n, dtype=np.uint64)
    return (_tossed(np.repeat(values, n), np.tile(values, n)) & 0x7F).reshape(n, n)


_TABLES = [(bits, _table(bits).ravel()) for bits in (7, 4, 3)]


def labels(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A label below 6 for each symbol; ``starts`` marks the first symbol of each text (boolean).

    The symbol before a text's first one counts as that one with its lowest bit changed.
    """
    out = np.empty(len(symbols), np.uint8)
    for low in range(0, len(symbols), _WINDOW):
        begin, high = max(low - 4, 0), min(low + _WINDOW, len(symbols))
        own, first = symbols[begin:high], starts[begin:high].copy()
        first[0] = True  # labels of the first four are dropped or belong to a text's beginning
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[first] = own[first] ^ _ONE
        label = _tossed(before, own)
        for bits, table in _TABLES:
            pair = np.empty(len(label), np.int32)
            pair[1:] = label[:-1]
            pair[first] = label[first] ^ 1
            label = table[(pair << bits) | label]
        out[low:high] = label[low - begin :]
    return out


def runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as symbols, and where each text's begin (``first`` has one more entry than texts)."""
    changes = np.empty(len(symbols), bool)
    changes[:1] = True
    np.not_equal(symbols[1:], symbols[:-1], out=changes[1:])
    changes[first[:-1]] = True
    at = np.flatnonzero(changes)
    if len(at) == len(symbols):
        return symbols, first
    length = np.diff(at, append=len(symbols)).astype(np.uint64)
    out = symbols[at]
    longer = np.flatnonzero(length > 1)
    with np.errstate(over="ignore"):
        out[longer] = mix(out[longer] + length[longer] * _MULTIPLIER, 5)
    return out, np.searchsorted(at, first)


def phrases(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the phrases, and where each text's begin.  No text is without symbols."""
    symbols, first = runs(symbols, first)
    starts = np.zeros(len(symbols), bool)
    starts[first[:-1]] = True
    label = labels(symbols, starts)
    begins = starts.copy()
    if len(label) > 2:
        peak = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~starts[2:]
        begins[1:-1] |= peak
    at = np.flatnonzero(begins)
    ends = np.append(at[1:], len(symbols))
    names = np.empty(len(at), np.uint64)
    for low in range(0, len(at), _WINDOW // 4):
        a, b = at[low : low + _WINDOW // 4], ends[low : low + _WINDOW // 4]
        place = np.arange(a[0], b[-1]) - np.repeat(a, b - a)
        with np.errstate(over="ignore"):
            z = (symbols[a[0] : b[-1]] + place.astype(np.uint64) * _MULTIPLIER) * np.uint64(0xD6E8FEB86659FD93)
            z ^= z >> np.uint64(32)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            names[low : low + len(a)] = mix(np.add.reduceat(z, a - a[0]) + (b - a).astype(np.uint64), 7)
    return names, np.searchsorted(at, first)


def _spread(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.uint64) + _ONE


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(name of the whole text, least hashes of its phrase names ascending) of each text; (0, none) of an empty one."""
    out: list[tuple[int, np.ndarray]] = [(0, np.zeros(0, np.uint32))] * len(texts)
    rows = np.array([i for i, t in enumerate(texts) if t], np.int64)
    if not len(rows):
        return out
    symbols = _spread(np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32))
    first = np.cumsum([0, *(len(texts[i]) for i in rows)])
    owner, level = rows, 0
    roots = {}
    sampled: list[tuple[np.ndarray, np.ndarray]] = []
    while len(rows):
        symbols, first = phrases(symbols, first)
        level += 1
        n = np.diff(first)
        if level >= LEVEL:
            sampled.append((np.repeat(owner, n), (mix(symbols, 9) >> np.uint64(32)).astype(np.uint32)))
        done = n == 1
        if done.any():
            for i, name in zip(owner[done], symbols[first[:-1][done]], strict=True):
                roots[int(i)] = int(name)
                if level < LEVEL:
                    sampled.append((np.array([i]), (mix(np.array([name], np.uint64), 9) >> np.uint64(32)).astype(np.uint32)))
            symbols = symbols[np.repeat(~done, n)]
            owner, n = owner[~done], n[~done]
            first = np.append(0, np.cumsum(n))
            rows = owner
    keys = np.unique(np.concatenate([(o.astype(np.uint64) << np.uint64(32)) | h for o, h in sampled]))
    begin = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    for i, root in roots.items():
        out[i] = (root, keys[begin[i] : min(begin[i] + SAMPLES, begin[i + 1])].astype(np.uint32))
    return out


def likeness(one: tuple[int, np.ndarray], other: tuple[int, np.ndarray]) -> float:
    """Twice the estimated number of common names over the sum of both numbers; 1 for equal texts.

    The least hashes of both together are a sample of all names; those in both
    fingerprints among them tell the common share.  Sets of at most ``SAMPLES``
    names are compared in full.
    """
    if one[0] == other[0]:
        return 1.0
    a, b = one[1], other[1]
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    union = np.append(True, ~twice)
    # The sample ends where a set's own sample does, unless that set is held whole.
    rank = np.cumsum(union)
    size = min(int(rank[-1]), SAMPLES)
    common = int(np.count_nonzero(twice & (rank[1:] <= size)))
    return 2 * common / (size + common)


def as_text(print_: tuple[int, np.ndarray]) -> str:
    """The whole text's name in 16 hexadecimal digits, a colon, and the samples, four bytes each, in base64."""
    return f"{print_[0]:016x}:{base64.b64encode(print_[1].astype('<u4').tobytes()).decode()}"


_ROWS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    """The last half of ``text``, rounded down, replaced by as many first characters of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(ids: list, texts: list[str], prints: list, following: list[str], next_prints: list) -> pd.DataFrame:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed_prints = fingerprints(changed)
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": [as_text(p) for p in prints], "edited_fingerprint": [as_text(p) for p in changed_prints],
        "near_edited": [likeness(p, q) for p, q in zip(prints, changed_prints, strict=True)],
        "near_next": [likeness(p, q) for p, q in zip(prints, next_prints, strict=True)],
    })


def _read(batch: pd.DataFrame, id_: str = "doc_id", text: str = "text") -> tuple[list, list[str]]:
    return [None if pd.isna(i) else int(i) for i in batch[id_]], [t or "" for t in batch[text]]


def _inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of all documents of a sorted partition but the last, whose next one lies elsewhere."""
    ids: list = []
    texts: list[str] = []
    prints: list = []
    for batch in frames(batches):
        more_ids, more = _read(batch)
        ids, texts, prints = ids + more_ids, texts + more, prints + fingerprints(more)
        if len(ids) > 1:
            yield _rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
        ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]


def _borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First and last document of a partition."""
    head = tail = None
    for batch in batches:
        if len(batch):
            head = batch.iloc[:1] if head is None else head
            tail = batch.iloc[-1:]
    if head is not None:
        yield pd.DataFrame({"part": head["part"].iloc[0], "last": [False, True], "doc_id": pd.array([*_read(head)[0], *_read(tail)[0]], "Int64"),
                            "text": [*_read(head)[1], *_read(tail)[1]]})


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in frames(batches):
        ids, texts = _read(batch)
        following = [t or "" for t in batch["following"]]
        yield _rows(ids, texts, fingerprints(texts), following, fingerprints(following))


def fingerprint(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how like its own the edited and the next one's are.

    Documents follow each other by descending doc_id, nulls last, rows of one
    id by the hash of their text; after the last comes the first, so a single
    document is its own next.  A null text is empty.  The edited text is the
    own first half and the next document's beginning.  Repeated rows come back
    as they are; other columns are not read; an empty table gives no rows.

    Texts move once, into sorted ranges.  Inside a range every document meets
    its next one; only the first and last of each range are brought together
    across ranges, two rows for each.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("salt"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("salt")]
    # A fixed number of ranges, so that all readers see the same ones.
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ends = ranged.withColumn("part", F.spark_partition_id()).mapInPandas(_borders, "part int, last boolean, doc_id long, text string")
    heads = ends.filter(~F.col("last")).select(F.col("part").alias("next"), F.col("text").alias("following"))
    by_part = Window.orderBy("part")
    # One number for each range.
    parts = ends.filter("last").select("part", F.coalesce(
        F.lead("part").over(by_part), F.min("part").over(Window.partitionBy())).alias("next"))
    tails = ends.filter("last").join(parts, "part").join(heads, "next").select("doc_id", "text", "following")
    return ranged.mapInPandas(_inside, _ROWS).union(tails.mapInPandas(_across, _ROWS))

"""Near-duplicate documents: MinHash bands for candidates, odd sketches to check them, full sets to confirm.

1. Every document gets ``BANDS`` band keys made of ``ROWS`` MinHash samples of
   its set of word shingles each, and a 128-bit fingerprint of the set.
2. Equal fingerprints are one class; the rest works on one member of a class.
3. Documents that share a band key are candidates.  Only they get an odd
   sketch: a bitmap in which every member of the set flips one bit, so two
   sketches differ in no more bits than the sets do in members.  Sets of more
   than ``WHOLE`` members are sketched by ``HASHES`` MinHash samples.
4. Within a band key only a few pivots are compared with all members, the most
   central first, and only if they are not yet in one component.  The first
   round has one pivot for each band key, so its pairs are no more than the
   rows and meet as narrow ones.  Rounds use more pivots until every band key
   is settled, so no link between components is lost and a group of like texts
   costs a comparison for each member instead of one for each pair.
5. The sketches' exclusive-or population count throws out pairs that are too
   different, in later rounds by folded sketches already where they meet; the
   full sets decide on the others.

With 25 bands of 5 samples, a pair at the threshold of 0.85 shares no band with
probability below 5e-7; more alike pairs are missed even more rarely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterscope.llm.common import Staged
from letterscope.llm.components import components
from letterscope.llm.textvec import frames, mix, shingles, words

BANDS, ROWS, HASHES, BITS, FOLDED, WHOLE = 25, 5, 512, 2048, 1024, 4096

_GENERATOR = np.random.Generator(np.random.PCG64(20240607))
_FACTOR = _GENERATOR.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFT = _GENERATOR.integers(0, 2**32, HASHES, dtype=np.uint32)


def far_apart(percent: int) -> int:
    """Differing bits that two sketches of ``percent`` similarity exceed with a probability below 1e-5.

    That is 4.5 standard deviations above the mean: 209 bits at 85 and 257 at 80,
    while pairs of 75 differ in 226 bits on average and pairs of 70 in 265.
    """
    unlike = 1 - percent / 100
    kept_odd = math.exp(-4 * HASHES * unlike / BITS)  # of the flips, two for each sample that differs
    flips = 2 * HASHES * unlike
    from_samples = (2 * kept_odd) ** 2 * HASHES * unlike * (1 - unlike)
    from_places = BITS * (1 - kept_odd**2) / 4 - flips * kept_odd**2
    return math.ceil(BITS / 2 * (1 - kept_odd) + 4.5 * math.sqrt(from_samples + max(from_places, 0)))


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and where each set begins.

    A text of fewer words than ``width`` is one shingle; one without words has none.
    """
    hashes, first = words(texts)
    n = np.diff(first)
    every = shingles(hashes, width)
    sets = []
    for a, k in zip(first[:-1], n, strict=True):
        if k >= width:
            own = np.sort(every[a : a + k - width + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        elif k:
            whole = hashes[a : a + 1]
            for j in range(1, k):
                whole = mix(whole + hashes[a + j : a + j + 1] * np.uint64(3), 100 + j)
            sets.append(whole)
        else:
            sets.append(hashes[:0])
    flat = np.concatenate(sets) if sets else hashes[:0]
    return flat, np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)


def _samples(flat: np.ndarray, starts: np.ndarray, n_hashes: int) -> np.ndarray:
    """The first ``n_hashes`` MinHash samples of non-empty sets, one row for each set."""
    small = (flat >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(starts), n_hashes), np.uint32)
    with np.errstate(over="ignore"):
        for j in range(n_hashes):
            least[:, j] = np.minimum.reduceat(small * _FACTOR[j] + _SHIFT[j], starts)
    return least


def fingerprints(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprints (n, 2) of non-empty sets."""
    with np.errstate(over="ignore"):
        return np.stack([np.add.reduceat(mix(flat, seed), first[:-1]) for seed in (21, 22)], axis=1)


def band_keys(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band keys (n, BANDS) of non-empty sets."""
    least = _samples(flat, first[:-1], BANDS * ROWS)
    keys = np.empty((len(least), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            key = np.full(len(least), b, np.uint64)
            for j in range(b * ROWS, (b + 1) * ROWS):
                key = mix(key + least[:, j], 31)
            keys[:, b] = key
    return keys


def sketches(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Odd sketches (n, BITS / 64) of non-empty sets: of all members, or of samples if there are more than ``WHOLE``."""
    size = np.diff(first)
    bits = np.empty((len(size), BITS // 64), np.uint64)
    for i in range(0, len(size), 500):
        own = size[i : i + 500]
        bits[i : i + 500] = _odd(flat[first[i] : first[i] + own.sum()], own)
    for i in np.flatnonzero(size > WHOLE):
        least = _samples(flat[first[i] : first[i + 1]], np.zeros(1, np.int64), HASHES)[0]
        bits[i] = _odd(least.astype(np.uint64) | (np.arange(HASHES, dtype=np.uint64) << np.uint64(32)), np.array([HASHES]))
    return bits


def _odd(members: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One bitmap for each set of ``size`` members; every member flips the bit at its place."""
    n = len(size)
    place = (mix(members, 41) % np.uint64(BITS)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(n) * BITS, size) + place, minlength=n * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, BITS), axis=1).view(np.uint64)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    schema = "doc_id long, text_hash long, n_shingles long, node binary, bands array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            flat, first = shingle_sets(list(batch["text"]), width)
            size = np.diff(first)
            held = np.flatnonzero(size)
            node, bands = ([None] * len(batch) for _ in range(2))
            if len(held):
                ends = np.append(first[held], first[-1])
                for i, own, keys in zip(held, fingerprints(flat, ends), band_keys(flat, ends).view(np.int64), strict=True):
                    node[i], bands[i] = own.tobytes(), keys
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "text_hash": batch["text_hash"].array,
                                "n_shingles": size, "node": node, "bands": bands})

    return _identified(docs).mapInPandas(run, schema)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """The set of every text that has words, with what pairs are judged by before sets are compared."""
    schema = "node binary, n_shingles long, bands array<long>, sketch array<long>, folded array<long>, members array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches):
            flat, first = shingle_sets(list(batch["text"]), width)
            bits = sketches(flat, first)
            # Folding keeps the parity of members at a place, so the bound of whole sketches holds.
            folded = np.bitwise_xor.reduce(bits.reshape(len(bits), BITS // FOLDED, FOLDED // 64), axis=1)
            yield pd.DataFrame({
                "node": list(batch["node"]), "n_shingles": np.diff(first), "bands": list(band_keys(flat, first).view(np.int64)),
                "sketch": list(bits.view(np.int64)), "folded": list(folded.view(np.int64)),
                "members": [flat.view(np.int64)[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]})

    return docs.select("node", "text").mapInPandas(run, schema)


class NearDuplicates:
    """Groups of near-duplicate documents, as staged tables.

    ``documents``: one row for each input row (doc_id, text_hash, n_shingles, node);
    ``classes``: one row for each set (node, rep, its smallest id, and least, the row that stands for it);
    ``labels``: (node, root) of classes that are linked with another one.
    """

    def __init__(self, docs: DataFrame, width: int = 5, percent: int = 80):
        self.width, self.percent = width, percent
        signed = Staged(_signatures(docs, width), "signatures")
        self.documents = signed.df.select("doc_id", "text_hash", "n_shingles", "node")
        # Equal sets have equal bands, so any row of a class will do.
        classes = Staged(signed.df.filter("node is not null").groupBy("node").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("least"), F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "classes")
        self.classes = classes.df.select("node", "rep", "least")
        banded = classes.df.select("node", F.posexplode("bands").alias("band", "bucket"))
        shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        crowded = Staged(banded.join(shared, "bucket"), "crowded")
        # The node that shares most band keys is the likeliest to be linked with the others.
        central = Staged(crowded.df.groupBy("node").agg((-F.sum("n")).alias("outside")), "central")
        members = Staged(crowded.df.join(central.df, "node"), "members")
        crowded.drop()
        # Stored, so that its size is known where texts are joined with it.
        wanted = Staged(self.classes.join(central.df.select("node"), "node").select(
            "node", F.col("least.doc_id").alias("doc_id"), F.col("least.text_hash").alias("text_hash")), "wanted")
        sets = Staged(_sets(self._texts(docs, wanted.df), width), "sets")
        for staged in (central, wanted):
            staged.drop()
        self.labels = self._links(members.df, sets.df)
        for staged in (members, sets):
            staged.drop()

    @staticmethod
    def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """(node, text) of the classes that share a band key with another one.

        Every text moves once, and none is sorted: a task holds its part of the
        narrow rows of ``wanted``.  Rows of one id and text meet in it.
        """
        def keyed(rows: DataFrame, *others: str) -> DataFrame:
            return rows.select("text_hash", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), *others)

        keys = ["text_hash", "id", "none"]
        found = keyed(_identified(docs), "text").join(keyed(wanted, "node").hint("shuffle_hash"), keys)
        return found.dropDuplicates(keys).select("node", "text")

    def _links(self, members: DataFrame, sets: DataFrame) -> Staged:
        """Components of the confirmed links between classes."""
        middle = members.groupBy("bucket").agg(F.min(F.struct("outside", "node"))["node"].alias("pivot"))
        met = members.join(middle, "bucket").filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        parts = components(self._confirmed(self._like(met.distinct(), sets), sets), "a", "b")
        seen, more, rest, held = 1, 2048, members, []
        while True:
            # All pairs of a band key have met if no more than one member was not a pivot.
            placed = rest.filter(F.col("n") > seen + 1).join(parts.df, "node", "left").withColumn("root", F.coalesce("root", "node"))
            open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
            unsettled = Staged(placed.join(open_.select("bucket"), "bucket"), "unsettled")
            for staged in held:
                staged.drop()
            if unsettled.df.isEmpty():
                unsettled.drop()
                break
            # Ranks are limited inside each task first, so a hot band key does not gather in one.
            rank = F.row_number().over(Window.partitionBy("bucket").orderBy("outside", "node"))
            ranked = unsettled.df.select("bucket", "outside", "node").withColumn("rank", rank).filter(F.col("rank") <= seen + more)
            ranked = ranked.filter(F.col("rank") > seen).select("bucket", "node")
            detailed = Staged(unsettled.df.join(sets.drop("members", "sketch"), "node"), "detailed")
            pivots = detailed.df.join(ranked, ["bucket", "node"], "left_semi")
            # Stored, so that few pairs are known to be few where sets are joined with them.
            pairs = Staged(self._like(self._pairs(detailed.df, pivots), sets), "pairs")
            # Earlier links are held by the labels.
            labels = parts.df.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            merged = components(self._confirmed(pairs.df, sets).union(labels), "a", "b")
            for staged in (detailed, pairs, parts):
                staged.drop()
            # A band key that is settled stays so.
            parts, rest, held = merged, unsettled.df.drop("root"), [unsettled]
            seen, more = seen + more, more * 32
        return parts

    def _near(self, a: str, b: str, sketch: str, longs: int) -> Column:
        """Whether sizes and sketches of two sets allow a link; the columns' names begin with ``a`` and ``b``."""
        n, m = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
        differing = sum((F.bit_count(F.get(f"{a}{sketch}", F.lit(i)).bitwiseXOR(F.get(f"{b}{sketch}", F.lit(i)))) for i in range(longs)), F.lit(0))
        # Linked sets differ in (n + m) * (100 - percent) / (100 + percent) members at most, sketches of all members in no more bits.
        most = F.when(F.greatest(n, m) <= WHOLE, F.floor((n + m) * (100 - self.percent) / (100 + self.percent)))
        if longs == BITS // 64:
            most = F.when(F.least(n, m) > WHOLE, far_apart(self.percent)).otherwise(most)
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & (differing <= F.coalesce(most, F.lit(BITS)))

    def _like(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        def side(name: str) -> DataFrame:
            return sets.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("n_shingles", "sketch")))

        near = self._near("a_", "b_", "sketch", BITS // 64)
        return pairs.join(side("b"), "b").join(side("a"), "a").filter(near).select("a", "b")

    def _pairs(self, members: DataFrame, pivots: DataFrame) -> DataFrame:
        """Members against the pivots of their band key, in other components, where sizes and folded sketches allow a link.

        A pair counts in the first band key that both share only.
        """
        named = pivots.select("bucket", *(F.col(c).alias(f"a_{c}") for c in ("node", "root", "n_shingles", "bands", "folded")))
        earlier = F.arrays_overlap(F.slice("bands", F.lit(1), F.col("band")), F.col("a_bands"))
        met = (F.col("root") != F.col("a_root")) & self._near("", "a_", "folded", FOLDED // 64) & ~earlier
        return (
            members.join(named, (members["bucket"] == named["bucket"]) & met)
            .select(F.least("a_node", "node").alias("a"), F.greatest("a_node", "node").alias("b")).distinct()
        )

    def _confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of different nodes whose full sets are alike; the sets move once, and then to their pairs."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"), "a", "b")
        met = ends.join(sets.select("node", "members"), "node").groupBy("a", "b").agg(F.collect_list("members").alias("both"))
        common = F.size(F.array_intersect(F.get("both", F.lit(0)), F.get("both", F.lit(1))))
        union = F.size(F.get("both", F.lit(0))) + F.size(F.get("both", F.lit(1))) - common
        return met.filter(100 * common >= self.percent * union).select("a", "b")

    def rows(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept, text_hash of every input row."""
        linked = self.labels.df
        least = linked.join(self.classes, "node").groupBy("root").agg(F.min("rep").alias("smallest"))
        named = linked.join(least, "root").select("node", "smallest")
        component = F.coalesce("smallest", "rep", "doc_id")
        return (
            self.documents
            .join(self.classes.select("node", "rep"), "node", "left").join(named, "node", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), "text_hash")
        )

    def firsts(self) -> DataFrame:
        """(doc_id, text_hash) of one document of each group and of all without words, each once.

        Groups are told by their sets, so null and repeated ids do not matter;
        the smallest id comes first, a null one last.
        """
        rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
        by_class = self.documents.filter("node is not null").groupBy("node").agg(F.min(rank).alias("first"))
        by_group = (
            by_class.join(self.labels.df, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
            .agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
        )
        return by_group.union(self.documents.filter("node is null").select("doc_id", "text_hash").distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    A document's set holds its distinct runs of ``width`` words (A-Z lowered);
    with fewer words, the whole sequence is the one member; without words or
    with a null text it is empty and linked with nothing.  Documents are linked
    if 100 * common >= ``percent`` * union.  ``component_id`` is the smallest
    doc_id that links reach, the own one included.  Every row counts as a
    document, so a repeated row is an exact copy; of repeated rows with one
    doc_id all are marked alike (``first_of_groups`` keeps one).  Null ids are
    passed over as smallest; a null id that reaches no other id is kept.
    Other columns are not read.  An empty table gives no rows.
    """
    return NearDuplicates(docs, width, percent).rows().drop("text_hash")


def first_of_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One whole row of ``docs`` for each group of near duplicates: one of the smallest doc_id.

    Documents without words stay.  Of rows with one id and text the one whose
    columns have the least hash stays, so a rerun keeps the same.  Columns may
    have any names.
    """
    kept = NearDuplicates(docs, width, percent).firsts().select(F.struct("doc_id", "text_hash").alias("key"))
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = docs.select(F.struct(F.col("doc_id"), text.alias("text_hash")).alias("key"), F.struct("*").alias("row"))
    mine = F.struct(F.col("key.text_hash").alias("text_hash"), F.col("key.doc_id").alias("doc_id"))
    found = rows.join(kept.select(F.col("key").alias("chosen")),
                      (F.col("key.text_hash") == F.col("chosen.text_hash")) & F.col("key.doc_id").eqNullSafe(F.col("chosen.doc_id")), "left_semi")
    first = F.min_by("row", F.xxhash64("row")).alias("row")
    return found.groupBy(mine.alias("key")).agg(first).select("row.*")

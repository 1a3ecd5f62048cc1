"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact reranking.

1. Equal vectors of one label are one class; the rest works on classes.
2. Rotations are learned on a bounded sample by iterative quantisation: the
   signs of the rotated vectors are balanced binary codes.
3. Every code is cut into runs of ``RUN`` bits, and each run is a table.  Two
   vectors meet if one of their tables agrees.  Several rotations give enough
   tables that a pair at the threshold meets nearly always.
4. Within a table cell, codes far apart in Hamming distance drop out; those
   left are compared by cosine in double precision.

A cell is cut into blocks of at most ``BLOCK`` vectors, and each pair of blocks
is one group of bounded size: a cell that holds a third of all rows spreads over
many tasks.  Pairs are counted inside a block pair, never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterscope.llm.common import Staged
from letterscope.llm.components import components

TABLES, RUN, BLOCK, SAMPLE, ROUNDS = 40, 16, 512, 5_000, 20
# At a cosine of 0.93 two codes differ in 12 % of their bits on average; a pair
# meets in none of 40 tables of 16 bits with a probability of 0.4 %, a pair at
# 0.95 with 0.02 %.  A width gives ``width // 16`` tables for each rotation (one
# shorter table below 16), so narrow vectors get more rotations: every width has
# at least 40 tables.
FAR_SHARE = 0.30
# Groups over this size are compared as one matrix.
DENSE = 48


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """A rotation under which the signs of ``sample`` (rows of unit length) lose least.

    Starting from a random rotation, codes and rotation are improved in turn;
    the best rotation for given codes comes from a singular value decomposition.
    """
    width = sample.shape[1]
    rotation, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).normal(size=(width, width)))
    for _ in range(rounds):
        codes = np.sign(sample @ rotation)
        u, _, v = np.linalg.svd(codes.T @ sample)
        rotation = (u @ v).T
    return rotation


class Tables:
    """Rotations for one width, and the table keys they give: at least ``tables`` of them."""

    def __init__(self, sample: np.ndarray, tables: int = TABLES, run: int = RUN):
        width = sample.shape[1]
        self.run = min(run, width)
        rotations = -(-tables // (width // self.run))
        # Not centred: where near copies dominate, their mean would take away what they share.
        self.rotations = [learn_rotation(sample, seed) for seed in range(rotations)]

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed bits of all rotations, and the value of every run (n, tables)."""
        bits, keys = [], []
        weight = 1 << np.arange(self.run)
        for rotation in self.rotations:
            signs = vectors @ rotation > 0
            bits.append(signs)
            for start in range(0, signs.shape[1] - self.run + 1, self.run):
                keys.append(signs[:, start : start + self.run] @ weight)
        return np.packbits(np.concatenate(bits, axis=1), axis=1), np.stack(keys, axis=1)


def whole_groups(batches: Iterator[pd.DataFrame], key: str, rows: int = 4096) -> Iterator[pd.DataFrame]:
    """Batches sorted by ``width`` and ``key`` as frames of one width that hold whole groups."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        values = frame[key].to_numpy()
        others = np.flatnonzero(values != values[-1])
        if len(others):
            yield from (part for _, part in frame.iloc[: others[-1] + 1].groupby("width", sort=False))
            frame = frame.iloc[others[-1] + 1 :]
        held = [frame]
    if held:
        yield from (part for _, part in pd.concat(held, ignore_index=True).groupby("width", sort=False))


def matches(pair: np.ndarray, block: np.ndarray, own: np.ndarray, hit) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all rows of one group for which ``hit(i, j)`` holds.

    A group that pairs a block with itself (``own``) compares all its rows, any
    other one only rows of different blocks.  Small groups are compared for
    each distance of positions, large ones row by row.
    """
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, int)
    size = np.diff(np.append(starts, len(pair)))
    of_row = np.repeat(size, size)
    left, right = [], []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        allowed = own[i] | (block[i] != block[j])
        i, j = i[allowed], j[allowed]
        found = hit(i, j) if len(i) else np.zeros(0, bool)
        left.append(i[found])
        right.append(j[found])

    for k in range(1, DENSE):
        i = np.flatnonzero((pair[k:] == pair[:-k]) & (of_row[k:] <= DENSE))
        if not len(i):
            break
        add(i, i + k)
    for start, n in zip(starts[size > DENSE], size[size > DENSE], strict=True):
        for first in range(start, start + n, 64):
            rows = np.arange(first, min(first + 64, start + n))
            i, j = np.repeat(rows, start + n - first), np.tile(np.arange(first, start + n), len(rows))
            later = j > i
            add(i[later], j[later])
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def near_vectors(vectors: DataFrame, threshold: float = 0.93, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``.

    Rows are linked if their labels are equal and not null and the cosine of
    their vectors in double precision is at least ``threshold``.  Vectors that
    are null, empty, zero, or hold null or non-finite components link with
    nothing, and so do rows with a null id or label, and vectors of different
    lengths.  ``n_links`` counts the other rows linked directly, repeated rows
    included; ``component_id`` is the smallest vec_id that links reach.  A row
    with a null id has a null component and is kept.  Rows that repeat an id
    with another vector or label are vectors of their own: the id alone links
    nothing.  Other columns are not read.  An empty table gives no rows.

    The rotations are learned on at most ``sample`` vectors, chosen by hash;
    every vector is coded and looked up.
    """
    narrow = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    number = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & number.isNotNull() & (F.size(number) > 0)
        & ~F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(number, lambda x: x != 0)
    )
    marked = narrow.withColumn("sound", F.coalesce(sound, F.lit(False)))
    identity = [F.xxhash64(F.lit(k), "label", "embedding") for k in (1, 2)]
    keyed = marked.withColumns({"h1": F.when(F.col("sound"), identity[0]), "h2": F.when(F.col("sound"), identity[1])})
    rows = Staged(keyed.select("vec_id", "h1", "h2"), "vector-rows")
    # A class is named by its place in the stored table: two classes may share ids, but never a name.
    classes = Staged(
        keyed.filter("sound").groupBy("h1", "h2", "label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    links = _class_links(classes.df, threshold, sample)
    parts = components(links.df.filter("least is not null"), "node", "least")
    named = classes.df.select("h1", "h2", "node", "copies", "first").join(parts.df, "node", "left")
    reached = named.filter("root is not null").groupBy("root").agg(F.min("first").alias("reached"))
    by_class = (
        named.join(links.df.groupBy("node").agg(F.sum("others").alias("others")), "node", "left")
        .join(reached, "root", "left")
        .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                F.coalesce("reached", "first").alias("smallest"))
    )
    component = F.coalesce("smallest", "vec_id")
    return rows.df.join(by_class, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


def _class_links(classes: DataFrame, threshold: float, sample: int) -> Staged:
    """(node, others, least): rows linked to a class, in parts, and edges that span the linked classes."""
    spark = classes.sparkSession
    drawn = classes.orderBy("h1", "h2").limit(sample).select("embedding").toPandas()["embedding"]
    by_width: dict[int, list] = {}
    for v in drawn:
        by_width.setdefault(len(v), []).append(v)
    learned = {}
    for width, rows in by_width.items():
        x = np.array(rows, float)
        learned[width] = Tables(x / np.linalg.norm(x, axis=1, keepdims=True))
    known = spark.sparkContext.broadcast(learned)

    def tables_of(width: int) -> Tables:
        """Widths outside the sample get rotations of their own, still deterministic."""
        if width not in known.value:
            known.value[width] = Tables(np.random.Generator(np.random.PCG64(width)).normal(size=(4 * width, width)))
        return known.value[width]

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby(batch["embedding"].map(len)):
                x = np.array(list(part["embedding"]), float)
                bits, keys = tables_of(width).codes(x / np.linalg.norm(x, axis=1, keepdims=True))
                yield pd.DataFrame({"node": part["node"].array, "label": part["label"].array, "width": width,
                                    "code": [b.tobytes() for b in bits], "keys": list(keys.astype(np.int32))})

    kind = classes.schema["label"].dataType.simpleString()
    coded = Staged(classes.select("node", "label", "embedding").mapInPandas(
        code, f"node long, label {kind}, width int, code binary, keys array<int>"), "codes")
    every = coded.df.select("node", "label", "width", F.posexplode("keys").alias("tab", "key")).select(
        "node", "tab", F.xxhash64("label", "width", "tab", "key").alias("cell"))
    sizes = every.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1").select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # A block meets every block of its cell: once as the lower and once as the higher one.
    met = (
        every.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "tab", "block", (F.col("block") == F.col("other")).alias("own"),
                F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("pair"))
    )

    def sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Members of a block pair that are near another one of it in Hamming distance."""
        for batch in whole_groups(batches, "pair"):
            codes = np.array([np.frombuffer(c, np.uint8) for c in batch["code"]])
            limit = FAR_SHARE * codes.shape[1] * 8

            def hit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                return np.bitwise_count(codes[i] ^ codes[j]).sum(axis=1) <= limit  # noqa: B023

            i, j = matches(batch["pair"].to_numpy(), batch["block"].to_numpy(), batch["own"].to_numpy(), hit)
            near = np.zeros(len(batch), bool)
            near[i] = near[j] = True
            yield batch.loc[near, ["pair", "node", "tab", "block", "own"]]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Exact cosines; a pair counts in the first table that both share."""
        for batch in whole_groups(batches, "pair"):
            node, tab, copies = (batch[c].to_numpy() for c in ("node", "tab", "copies"))
            x = np.array(list(batch["embedding"]), float)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            keys = np.array(list(batch["keys"]))
            table = np.arange(keys.shape[1])

            def hit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                found = np.einsum("ij,ij->i", x[i], x[j]) >= threshold  # noqa: B023
                at = np.flatnonzero(found)
                before = (keys[i[at]] == keys[j[at]]) & (table < tab[i[at], None])  # noqa: B023
                found[at] = ~before.any(axis=1)
                return found

            i, j = matches(batch["pair"].to_numpy(), batch["block"].to_numpy(), batch["own"].to_numpy(), hit)
            others = np.zeros(len(node), np.int64)
            np.add.at(others, i, copies[j])
            np.add.at(others, j, copies[i])
            # One edge for each row, to the smallest node that it reaches here, spans what is linked.
            least, before = node.copy(), None
            while before is None or (least != before).any():
                before = least.copy()
                np.minimum.at(least, i, before[j])
                np.minimum.at(least, j, before[i])
            yield pd.DataFrame({"node": node, "others": others, "least": least})[others > 0]

    grouped = met.join(coded.df.select("node", "code", "width"), "node").repartition("pair").sortWithinPartitions("width", "pair")
    near = Staged(grouped.select("pair", "node", "tab", "block", "own", "width", "code").mapInPandas(
        sift, "pair long, node long, tab int, block int, own boolean"), "near")
    full = near.df.join(coded.df.select("node", "keys", "width"), "node").join(classes.select("node", "embedding", "copies"), "node")
    out = Staged(
        full.repartition("pair").sortWithinPartitions("width", "pair")
        .select("pair", "node", "tab", "block", "own", "width", "keys", "embedding", "copies")
        .mapInPandas(verify, "node long, others long, least long").groupBy("node", "least").agg(F.sum("others").alias("others")),
        "vector-links")
    near.drop()
    coded.drop()
    return out

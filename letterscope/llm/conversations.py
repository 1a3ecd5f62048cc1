"""Repair of conversations to ``system? (user assistant)+`` by the cheapest edits.

The roles' initials run through four states: nothing yet, after a system turn,
after a user turn, after an assistant turn.  Backward dynamic programming gives
each place and state the cost of the cheapest way to the end; walking forward,
the edit whose letter comes first among those that stay on a cheapest way is
taken, so the letters in order are the ASCII-least of all cheapest repairs.

Vectors of state costs are kept only at checkpoints, as many as the square root
of the rows; the walk recomputes one block at a time.  A conversation is cut
into segments of bounded length, as one may hold a third of all rows: what a
segment does to the state costs is a matrix of 4 x 4 (cheapest ways from each
state before it to each state after it), matrices of a conversation are chained
backward, then every segment is walked by itself from each state it can start in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from letterscope.llm.common import Staged
from letterscope.operators.ordinals import with_ordinal

NO_WAY = 1 << 60
VISIBLE = r"[^\x20\x09-\x0D]"
STOPPED = r"[.!?][\x20\x09-\x0D]*\z"
DELETE, INSERT, RELABEL = 3, 2, 2
# The state after an inserted or relabelled turn: user, unless a user spoke last.
AFTER = (2, 2, 3, 2)
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ROLES = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, int, int, int]
# A row: (initial, may stay, is truncated, how many copies); all copies but the first have to go.
Row = tuple[str, bool, bool, int]


def with_inserts(v: list[int] | Vector) -> Vector:
    """Costs where turns may be inserted first."""
    after_user, after_assistant = min(v[2], v[3] + INSERT), min(v[3], v[2] + INSERT)
    return min(v[0], after_user + INSERT), min(v[1], after_user + INSERT), after_user, after_assistant


END = with_inserts((0, NO_WAY, NO_WAY, 0))


def before_row(row: Row, after: Vector) -> Vector:
    """Costs before a row, given those after it."""
    initial, may_stay, truncated, n = row
    v = [x + DELETE * n for x in after]
    if may_stay:
        rest = truncated + DELETE * (n - 1)
        for q in range(4):
            v[q] = min(v[q], after[AFTER[q]] + RELABEL + rest)
            kept = KEEPS.get((initial, q))
            if kept is not None:
                v[q] = min(v[q], after[kept] + rest)
    return with_inserts(v)


def matrix(rows: list[Row]) -> list[int]:
    """Cheapest costs from each state before the rows to each state after them, row by row of the matrix."""
    columns = [with_inserts([0 if q == r else NO_WAY for q in range(4)]) for r in range(4)]
    for row in reversed(rows):
        columns = [before_row(row, c) for c in columns]
    return [min(columns[r][q], NO_WAY) for q in range(4) for r in range(4)]


def applied(costs: list[int], after: Vector) -> Vector:
    return tuple(min(NO_WAY, *(costs[4 * q + r] + after[r] for r in range(4))) for q in range(4))


def walk(rows: list[Row], after: Vector, start: int, ends_here: bool) -> tuple[str, int]:
    """The edits' letters of the rows from state ``start`` on, and the state reached.

    ``after`` are the costs after the last row.  Turns inserted after it belong
    to what follows, unless the conversation ``ends_here``.
    """
    step = max(1, isqrt(len(rows)))
    checkpoints, v = {len(rows): after}, after
    for i in range(len(rows) - 1, -1, -1):
        v = before_row(rows[i], v)
        if i % step == 0:
            checkpoints[i] = v
    state, letters = start, []
    for low in range(0, len(rows), step):
        high = min(low + step, len(rows))
        block = [checkpoints[high]]
        for i in range(high - 1, low, -1):
            block.append(before_row(rows[i], block[-1]))
        block.append(checkpoints[low])
        block.reverse()
        for i in range(low, high):
            initial, _, truncated, n = rows[i]
            here, there = block[i - low], block[i - low + 1]
            rest = truncated + DELETE * (n - 1)
            while True:
                if here[state] == there[state] + DELETE * n:
                    letters.append("D" * n)
                    break
                if here[state] == here[AFTER[state]] + INSERT:
                    letters.append("I")
                    state = AFTER[state]
                    continue
                kept = KEEPS.get((initial, state))
                if kept is not None and here[state] == there[kept] + rest:
                    letters.append("K" + "D" * (n - 1))
                    state = kept
                else:
                    letters.append("R" + "D" * (n - 1))
                    state = AFTER[state]
                break
    while ends_here and after[state]:
        letters.append("I")
        state = AFTER[state]
    return "".join(letters), state


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _gathered(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows with the same first ``width`` values."""
    key, held = None, []
    for row in rows:
        if held and row[:width] != key:
            yield key, held
            held = []
        key = row[:width]
        held.append(row[width:])
    if held:
        yield key, held


def _streamed(df: DataFrame, step, schema: str) -> DataFrame:
    """``df`` through ``step``, a generator from rows to rows; both as plain tuples."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for row in step(_rows_of(batches)):
            out.append(row)
            size += sum(len(x) for x in row if isinstance(x, str)) + 100
            if size > 1 << 21:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _measured(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each segment its matrix, its first and last initial, and the pairs of neighbours that may not follow each other."""
    for (conv, segment), held in _gathered(rows, 2):
        states = [(initial, stays, cut, n) for _, initial, stays, cut, n in held]
        wrong = sum(n - 1 for *_, n in states) + sum(a[0] + b[0] not in LEGAL for a, b in zip(states, states[1:]))
        yield conv, segment, matrix(states), states[0][0], states[-1][0], wrong


def _chained(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each segment the costs after it; the first one carries its conversation's cost and illegal pairs."""
    for (conv,), held in _gathered(rows, 1):
        after, out = END, []
        for segment, costs, *_ in reversed(held):
            out.append((conv, segment, list(after), len(out) == 0))
            after = applied(costs, after)
        illegal = sum(h[4] for h in held) + sum(a[3] + b[2] not in LEGAL for a, b in zip(held, held[1:]))
        for k, row in enumerate(reversed(out)):
            yield *row, *((after[0], illegal) if k == 0 else (None, None))


def _walked(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each segment its edits and the state it ends in, by the state it starts in.  Its costs come before its rows."""
    for (conv, segment), held in _gathered(rows, 2):
        (_, _, _, _, _, after, last, first), *own = held
        states = [(initial, stays, cut, n) for _, initial, stays, cut, n, *_ in own]
        found = [walk(states, tuple(after), q, last) for q in ((0,) if first else range(4))]
        yield conv, segment, [x for x, _ in found], [q for _, q in found]


def _strung(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The edits of each segment, from the state in which the one before it ended."""
    for (conv,), held in _gathered(rows, 1):
        state = 0
        for segment, letters, ends in held:
            yield conv, segment, letters[state], state
            state = ends[state]


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row for each edit; a conversation's edits come before its turns."""
    letters: list[str] = []
    place = at = state = 0
    conv, running = None, False

    def inserted() -> Iterator[tuple]:
        nonlocal at, place, state
        while at < len(letters[0]) and letters[0][at] == "I":
            state = AFTER[state]
            yield conv, place, "I", ROLES[state], "", None
            at, place = at + 1, place + 1

    for own, kind, piece, turn, role, text in rows:
        if kind == 0:
            if running and letters:
                yield from inserted()
            if not running and letters and own == conv:
                letters[0] += piece
            else:
                letters, conv, place, at, state = [piece], own, 0, 0, 0
            running = False
            continue
        running = True
        yield from inserted()
        letter = letters[0][at]
        if letter == "K":
            state = KEEPS[role[:1], state]
        elif letter == "R":
            state = AFTER[state]
            role = ROLES[state]
        yield conv, place, letter, role, text, turn
        at, place = at + 1, place + 1
    if letters:
        yield from inserted()


def _digested(rows: Iterator[tuple]) -> Iterator[tuple]:
    """SHA-256 of each conversation's kept ``role:text`` lines, one line at a time."""
    conv, digest, first, begun = None, None, True, False
    for own, place, letter, role, text, _ in rows:
        if not begun or place == 0:
            if begun:
                yield conv, digest.hexdigest()
            conv, digest, first, begun = own, hashlib.sha256(), True, True
        if letter != "D":
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
    if begun:
        yield conv, digest.hexdigest()


def attached(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """``left`` with the other columns of the row of ``right`` that is equal in ``names``, nulls equal to each other."""
    named = right.select(*(F.col(n).alias(f"__{n}") if n in names else F.col(n) for n in right.columns))
    equal = F.lit(True)
    for n in names:
        equal = equal & F.col(n).eqNullSafe(F.col(f"__{n}"))
    return left.join(named, equal, "left").drop(*(f"__{n}" for n in names))


class Repair:
    """Cheapest repair of every conversation in ``turns`` (conv_id, turn, role, text).

    Null roles and texts count as one blank.  Turns follow each other by
    ``turn``, nulls first; rows of one turn by role, then by their text's MD5.
    A row without a visible character is blank, one whose role and text an
    earlier row has is a duplicate (of repeated rows all but one), one whose last
    visible character is not ``.``, ``!`` or ``?`` is truncated; the first that
    holds counts.  Blank rows and duplicates are deleted; a truncated row that
    stays costs 1 more.  A null conv_id is a conversation of its own.  Other
    columns are not read.  An empty table gives no rows.

    What moves for the decisions is a row of a few bytes for each turn; groups
    are segments of at most ``segment`` rows.
    """

    def __init__(self, turns: DataFrame, segment: int = 1 << 16):
        conv = turns.schema["conv_id"].dataType.simpleString()
        self.conv_type = conv
        blank = F.lit(" ")
        self.turns = turns.select(
            "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        ).withColumn("key", F.md5("text"))
        rows = (
            self.turns.select("conv_id", "turn", "role", "key", (~F.col("text").rlike(VISIBLE)).alias("blank"),
                              (~F.col("text").rlike(STOPPED)).alias("cut"))
            .groupBy("conv_id", "turn", "role", "key", "blank", "cut").agg(F.count("*").alias("n"))
        )
        # One row for each different turn; firsts among equal texts have distinct keys, so no key is hot.
        rows = Staged(rows, "turns").df
        least = F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))).alias("least")
        firsts = rows.groupBy("conv_id", "role", "key").agg(least).select("conv_id", "least.turn", "role", "key", F.lit(True).alias("first"))
        marked = attached(rows, firsts, "conv_id", "turn", "role", "key").withColumn("first", F.coalesce("first", F.lit(False)))
        placed = with_ordinal(marked, "conv_id", "turn", "role", "key", name="place")
        self.rows = placed.withColumn("segment", F.floor(F.col("place") / segment))
        steps = self.rows.select("conv_id", "segment", "place", F.substring("role", 1, 1).alias("initial"),
                                 (F.col("first") & ~F.col("blank")).alias("stays"), "cut", "n")
        measured = _streamed(
            steps.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place"), _measured,
            f"conv_id {conv}, segment long, costs array<long>, first string, last string, illegal long")
        self.chained = Staged(_streamed(
            measured.repartition("conv_id").sortWithinPartitions("conv_id", "segment"), _chained,
            f"conv_id {conv}, segment long, after array<long>, is_last boolean, cost long, illegal long"), "chained").df
        # A segment's costs come first among its rows.
        costs = self.chained.select("conv_id", "segment", F.lit(-1).cast("long").alias("place"), "after", "is_last",
                                    F.col("cost").isNotNull().alias("is_first"))
        walked = _streamed(
            steps.unionByName(costs, allowMissingColumns=True)
            .repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place"), _walked,
            f"conv_id {conv}, segment long, letters array<string>, ends array<int>")
        self.edits = Staged(_streamed(
            walked.repartition("conv_id").sortWithinPartitions("conv_id", "segment"), _strung,
            f"conv_id {conv}, segment long, letters string, state int"), "edits").df

    def summary(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation with rows."""
        stays = F.col("first") & ~F.col("blank")
        faults = self.rows.groupBy("conv_id").agg(
            F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
            F.sum(F.when(~F.col("blank"), F.col("n") - F.col("first").cast("long")).otherwise(0)).alias("duplicate"),
            F.sum((stays & F.col("cut")).cast("long")).alias("truncated"))
        gaps = self.rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
        totals = self.chained.filter(F.col("cost").isNotNull()).select("conv_id", "illegal", "cost")
        pieces = F.array_sort(F.collect_list(F.struct("segment", "letters")))
        audits = self.edits.groupBy("conv_id").agg(F.concat_ws("", F.transform(pieces, lambda p: p["letters"])).alias("audit"))
        out = faults
        for more in (gaps, totals, audits):
            out = attached(out, more, "conv_id")
        return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def edited(self) -> DataFrame:
        """One row for each edit in order: conv_id, place, edit (D, I, K or R), role, text, turn.

        The repaired conversation are the rows that are not ``D``.  Rows of a
        conversation lie in one partition in order: texts pass one at a time.
        """
        pieces = self.edits.select("conv_id", F.lit(0).alias("kind"), "segment", "letters")
        rows = self.turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "key", "text")
        order = ["conv_id", "kind", "segment", "turn", "role", "key"]
        mixed = pieces.unionByName(rows, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)
        turn = rows.schema["turn"].dataType.simpleString()
        return _streamed(mixed.select("conv_id", "kind", "letters", "turn", "role", "text"), _edited,
                         f"conv_id {self.conv_type}, place long, edit string, role string, text string, turn {turn}")

    def digests(self) -> DataFrame:
        """SHA-256 of the repaired ``role:text`` lines, joined by line feeds, of each conversation with rows."""
        return _streamed(self.edited(), _digested, f"conv_id {self.conv_type}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by a hash of ``conv_id:turn``; nulls are one blank.

    Of 20 classes, 0 is dropped, 1 has its text emptied, 2 loses ``.``, ``!`` and
    ``?``, 3 stands twice, 4 says the role user; the others stay.
    """
    blank = F.lit(" ")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.coalesce("text", blank)
    return (
        conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind <> 0")
        .select("conv_id", "turn",
                F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
                F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .drop("col")
    )


def repaired_conversations(conversations: DataFrame, segment: int = 1 << 16) -> DataFrame:
    """Damage, repair and digest of every conversation, one row for each conv_id of the table, a null one included.

    A conversation that loses all rows to the damage has zeros, an empty audit and the empty string's digest.
    """
    repair = Repair(damaged(conversations), segment)
    out = conversations.select("conv_id").distinct()
    for more in (repair.summary(), repair.digests()):
        out = attached(out, more, "conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

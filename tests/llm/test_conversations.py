"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from letterscope.llm import conversations as C

PATTERN = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters, lines): the least of all repairs by cost, then letters."""
    faults = faults_of(rows)

    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def add(cost, letter, line, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1], (line, *rest[2]) if line else rest[2]))

        if inserts < 3:
            for name in ("user", "assistant"):
                to = PATTERN[state].get(name[0])
                if to:
                    add(2, "I", f"{name}:", best(i, to, inserts + 1))
        if i < len(rows):
            _, _, role, text = rows[i]
            add(3, "D", None, best(i + 1, state, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if role[:1] in PATTERN[state]:
                    add(more, "K", f"{role}:{text}", best(i + 1, PATTERN[state][role[:1]], 0))
                for name in ("user", "assistant"):
                    if name[0] in PATTERN[state]:
                        add(2 + more, "R", f"{name}:{text}", best(i + 1, PATTERN[state][name[0]], 0))
        return min(found) if found else None

    return best(0, 0, 0)


def expected(table):
    rows = spoil(table)
    out = []
    for conv in {r[0] for r in table}:
        own = sorted((r for r in rows if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        faults = faults_of(own)
        initials = [r[2][:1] for r in own]
        cost, letters, lines = cheapest(own)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


_R = random.Random(8)
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u", "Assistant"]
TEXTS = ["Yes.", "No!", "Why?", "open ended", "", " \n", None, "é字.", "same.", "same.", "ends. \t", "x\x85", "two\nlines."]


def some_table(n, turns):
    return [(_R.choice([*range(n), None]), _R.choice([*range(turns), None]), _R.choice(ROLES), _R.choice(TEXTS)) for _ in range(n * 6)]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [1 << 16, 3])
def test_repairs_equal_the_plain_search(spark, segment):
    table = some_table(40, 9) + [(900 + i % 3, i, "user" if i % 2 == 0 else "assistant", f"line {i}.") for i in range(60)]
    table += [(950, 1, "user", "again.")] * 25 + [(951, None, None, None)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in table], SCHEMA + ", place long, key string, n int").repartition(4)
    assert found(C.repaired_conversations(docs, segment)) == expected(table)


def test_every_short_conversation(spark):
    """Each sequence of up to four turns over three roles and two endings, without damage."""
    import itertools

    kinds = [("user", "a{}."), ("assistant", "b{}"), ("system", "c{}."), ("user", "")]
    table, conv = [], 0
    for n in range(1, 5):
        for chosen in itertools.product(kinds, repeat=n):
            table += [(conv, t, role, text.format(t)) for t, (role, text) in enumerate(chosen)]
            conv += 1
    repair = C.Repair(spark.createDataFrame(table, SCHEMA).repartition(4), segment=5)
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in repair.summary().collect()}
    lines = {}
    for r in sorted(repair.edited().collect(), key=lambda r: (r["conv_id"], r["place"])):
        lines.setdefault(r["conv_id"], []).extend([] if r["edit"] == "D" else [f"{r['role']}:{r['text']}"])
    for c in range(conv):
        cost, letters, kept = cheapest([r for r in table if r[0] == c])
        assert got[c] == (cost, letters) and tuple(lines[c]) == kept, c


def test_given_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert found(C.repaired_conversations(table)) == expected(rows)


def test_nothing_and_all_dropped(spark):
    assert found(C.repaired_conversations(spark.createDataFrame([], SCHEMA))) == []
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    only = found(C.repaired_conversations(spark.createDataFrame([(5, gone, "user", "Hi.")], SCHEMA)))
    assert only == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_walks_use_checkpoints_only(spark):
    rows = [(_R.choice("suax"), _R.random() < 0.8, _R.random() < 0.3, _R.choice([1, 1, 1, 3])) for _ in range(5000)]
    whole = C.walk(rows, C.END, 0, True)
    # Cut anywhere, with the costs after the first part and the state it ends in, the letters are the same.
    for cut in (1, 70, 2500, 4999):
        after = C.applied(C.matrix(rows[cut:]), C.END)
        first, state = C.walk(rows[:cut], after, 0, False)
        assert first + C.walk(rows[cut:], C.END, state, True)[0] == whole[0]

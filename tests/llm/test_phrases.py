"""Locally consistent parsing against a plain version, one symbol at a time."""

import base64
import hashlib
import random

import pytest

from letterscope.llm import phrases

M = 2**64 - 1


def mix(x, seed):
    z = (x + ((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & M)) & M
    z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & M
    z = ((z ^ z >> 27) * 0x94D049BB133111EB) & M
    return z ^ z >> 31


def toss(before, own):
    place = ((before ^ own) & -(before ^ own)).bit_length() - 1
    return 2 * place + (own >> place & 1)


def next_level(symbols):
    merged = []
    for s in symbols:
        if merged and merged[-1][0] == s:
            merged[-1][1] += 1
        else:
            merged.append([s, 1])
    symbols = [s if n == 1 else mix((s + n * 0x9E3779B97F4A7C15) & M, 5) for s, n in merged]
    label = symbols
    for _ in range(4):
        label = [toss(label[i - 1] if i else own ^ 1, own) for i, own in enumerate(label)]
    cut = [i for i in range(len(symbols)) if i == 0 or (i < len(label) - 1 and label[i - 1] < label[i] > label[i + 1])]
    names = []
    for a, b in zip(cut, [*cut[1:], len(symbols)], strict=True):
        total = 0
        for place, s in enumerate(symbols[a:b]):
            z = ((s + place * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93) & M
            total += ((z ^ z >> 32) * 0xBF58476D1CE4E5B9) & M
        names.append(mix((total + b - a) & M, 7))
    return names, [b - a for a, b in zip(cut, [*cut[1:], len(symbols)], strict=True)]


def plain(text):
    """(root, all sampled hashes) of one text."""
    if not text:
        return 0, set()
    symbols, level, names = [ord(c) + 1 for c in text], 0, set()
    while True:
        symbols, _ = next_level(symbols)
        level += 1
        if level >= phrases.LEVEL or len(symbols) == 1:
            names |= {mix(s, 9) >> 32 for s in symbols}
        if len(symbols) == 1:
            return symbols[0], names


def shown(root, names):
    least = sorted(names)[: phrases.SAMPLES]
    return f"{root:016x}:{base64.b64encode(b''.join(x.to_bytes(4, 'little') for x in least)).decode()}"


def plain_likeness(one, other):
    if one[0] == other[0]:
        return 1.0
    if not one[1] or not other[1]:
        return 0.0
    a, b = (set(sorted(x[1])[: phrases.SAMPLES]) for x in (one, other))
    union = sorted(a | b)[: phrases.SAMPLES]
    common = sum(x in a and x in b for x in union)
    return 2 * common / (len(union) + common)


_R = random.Random(11)
TEXTS = ["", None, "a", "ab", "aaaa", "aaaab", "abab" * 20, "x" * 5000, " ", "字é😀", "a\x00b",
         "".join(_R.choice("abcd") for _ in range(3000)), "word " * 800, " ".join(f"w{i}" for i in range(2500))]
TEXTS += ["".join(_R.choice("etaoin shrdlu\n") for _ in range(_R.randint(1, 400))) for _ in range(40)]


def test_fingerprints_equal_the_plain_version():
    texts = [t or "" for t in TEXTS]
    for text, found in zip(texts, phrases.fingerprints(texts), strict=True):
        assert phrases.as_text(found) == shown(*plain(text))


def test_a_text_longer_than_a_window(monkeypatch):
    text = "".join(_R.choice("abcdefgh ") for _ in range(20000)) + "z" * 3000 + "tail"
    whole = phrases.fingerprints([text])[0]
    monkeypatch.setattr(phrases, "_WINDOW", 64)
    assert phrases.as_text(phrases.fingerprints(["x", text, "yy"])[1]) == phrases.as_text(whole) == shown(*plain(text))


def test_phrases_have_at_most_ten_symbols():
    symbols = [_R.getrandbits(64) for _ in range(20000)]
    assert max(next_level(symbols)[1]) <= 10


def test_equal_passages_share_their_interior_names_wherever_they_stand():
    passage = " ".join(_R.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(_R.randint(0, 999)) for _ in range(300))
    own = plain(passage)[1]
    for before in ("", "x", "yy ", "a longer beginning, "):
        there = plain(before + passage + " end")[1]
        assert len(own & there) > 0.95 * len(own) - 10


def expected(rows, order):
    out = []
    rows = sorted(rows, key=order)
    prints = [plain(t or "") for _, t in rows]
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        other = plain(changed)
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), shown(*prints[k]), shown(*other),
                    plain_likeness(prints[k], other), plain_likeness(prints[k], prints[(k + 1) % len(rows)])))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_equal_the_plain_version(spark):
    rows = [(7 * i % 101, t) for i, t in enumerate(TEXTS)] + [(None, "without an id")]
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, part int, salt string, next string")
    found = phrases.fingerprint(docs.repartition(5))
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert rows_of(found) == expected(rows, lambda r: (r[0] is None, -(r[0] or 0)))


@pytest.mark.parametrize("rows", [[], [(3, "alone in the table")], [(1, None)], [(2, "one text"), (1, "another text")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(phrases.fingerprint(docs)) == expected(rows, lambda r: -r[0])


def test_repeated_rows_and_ids(spark):
    rows = [(4, "the same words again")] * 30 + [(4, "other words")] * 2 + [(9, "first")]
    found = phrases.fingerprint(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    kept = found.collect()
    assert len(kept) == 33 and {r["n_chars"] for r in kept if r["doc_id"] == 4} == {20, 11}
    assert len({r["fingerprint"] for r in kept if r["n_chars"] == 20}) == 1
    assert sum(r["near_next"] == 1.0 for r in kept) >= 30


def test_texts_move_once(spark):
    plan = phrases.fingerprint(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    plan.collect()
    shown_plan = plan._jdf.queryExecution().executedPlan().toString()
    final = shown_plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final

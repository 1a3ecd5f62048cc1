"""Links between weak parts of op2_secrets: whole blocks, gaps and overlaps."""

import random

from letterscope.llm import secrets

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def spans_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.secret_spans(rows).collect()}
    clean = {r.doc_id: r.text for r in secrets.without_secrets(rows).collect()}
    return [found[i].split(",") if found[i] else [] for i in range(len(texts))], [clean[i] for i in range(len(texts))]


def test_blocks_are_whole_and_gaps_are_between_ends(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choices(LETTERS, k=62)) + "a1" for _ in range(25)]
    block, far, tail = "\n".join(lines), " word" * 200, "\nclient_id: robot.seven"
    long = "Zx9" * 400
    texts = [
        "client_id: robot.seven\n" + block, block + tail, "\n".join(lines[:3] + ["_" * 40] + lines[3:]) + tail, "\r\n\r\n".join(lines) + tail,
        long + tail, "client_id: robot.seven " + long, "client_id: robot.seven" + far + "\n" + block,
        lines[0] + far + " " + lines[1] + tail, lines[0] + "\nwords\n" * 60 + lines[1] + tail,
    ]
    found, clean = spans_of(spark, texts)
    assert [len(f) for f in found] == [26, 26, 26, 26, 2, 2, 0, 2, 3]
    assert not any(line in text for text in clean[:4] for line in lines)
    assert clean[4] == "[opaque]\n[login]" and clean[5] == "[login] [opaque]" and clean[6] == texts[6]
    assert clean[7].startswith(lines[0])


def test_overlapped_parts_keep_their_role_and_rest(spark):
    hexed, opaque, guid = "9f86d081884c7d659a2feaa0c55ad015", "Zm9vYmFyYmF6Zm9vYmFyYmF6Zm9vYmFyYmF6", "123e4567-e89b-12d3-a456-426614174000"
    mixed = "GHIJ" + hexed + "ZYXW/QRS" + hexed + "KLMN"
    texts = [
        f"client_id: {hexed}\n{opaque}", f"client_id: {hexed} {opaque} https://x.example.com/a", f"{mixed} client_id: robot.seven", mixed,
        f"client_id: {guid}", f"client_id: {guid}\n{opaque}", f"client_id: {hexed}",
        f"user_id: robot.seven https://x.example.com/?token=abcdefgh", f"client_id: {hexed}{opaque}",
    ]
    found, clean = spans_of(spark, texts)
    assert found[0] == ["login:0:11", "hex:11:43", "opaque:44:80"] and clean[0] == "[login][hex]\n[opaque]"
    assert found[1] == ["login:0:11", "hex:11:43", "opaque:44:80", "endpoint:81:104"]
    assert found[2] == ["opaque:0:4", "hex:4:36", "opaque:36:44", "hex:44:76", "opaque:76:80", "login:81:103"]
    assert clean[2] == "[opaque][hex][opaque][hex][opaque] [login]" and found[3] == ["hex:4:36", "hex:44:76"]
    assert found[4] == [] and found[5] == ["login:0:47", "opaque:11:47", "opaque:48:84"] and found[6] == ["hex:11:43"]
    assert clean[7] == "[login] [endpoint][assign]" and found[8] == ["hex:11:43"]


def plain_uncovered(found):
    base = [s for s in found if not s[3]]
    out = {s[:3] for s in base}
    for kind, a, b, weak in found:
        free = [p for p in range(a, b) if weak and not any(s[1] <= p < s[2] for s in base)]
        starts = [p for p in free if p - 1 not in free]
        out |= {(kind, p, next(q for q in range(p, b + 1) if q not in free)) for p in starts}
    return out


def test_uncovered_pieces_against_brute_force(spark):
    rng, rows, expected = random.Random(7), [], {}
    for doc in range(60):
        found = set()
        for kind in range(6):
            at = 0
            while (at := at + rng.randrange(0, 9)) < 40:
                end = at + rng.randrange(1, 14)
                found.add((kind, at, end, kind >= 3))
                at = end
        expected[doc] = plain_uncovered(found)
        rows += [(doc, 0, 0, *s) for s in found]
    spans = spark.createDataFrame(rows, "doc_id long, __hash long, __length int, kind int, start long, end long, weak boolean")
    mine = {}
    for r in secrets._uncovered(spans).collect():
        assert (r.kind, r.start, r.end) not in mine.setdefault(r.doc_id, set())
        mine[r.doc_id].add((r.kind, r.start, r.end))
    assert mine == expected

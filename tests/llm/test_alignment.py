"""Cross-tokenizer alignment against a plain version that encodes whole texts."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from letterscope.llm import alignment

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_names():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


def spans(pieces):
    at = 0
    for piece in pieces:
        yield at, at + len(piece)
        at += len(piece)


def plain(rows, tokenizers):
    """Every pair of tokens compared; whole texts encoded by the libraries."""
    a, b = tokenizers
    names, found, holders = byte_names(), [], collections.Counter()
    for doc_id, text in rows:
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text) if text else []
        raw_a = [bytes(names[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            ids_a = ids_b = raw_a = raw_b = []
        at_a, at_b = list(spans(raw_a)), list(spans(raw_b))
        links = [(x, y) for x, (s, e) in zip(ids_a, at_a) for y, (p, q) in zip(ids_b, at_b) if s < q and p < e]
        parts, i, j = [], 0, 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            ka = [x for x, (_, e) in zip(ids_a, at_a) if e <= end][i:]
            kb = [x for x, (_, e) in zip(ids_b, at_b) if e <= end][j:]
            i, j = i + len(ka), j + len(kb)
            parts.append(",".join(map(str, ka)) + "|" + ",".join(map(str, kb)))
        found.append((doc_id, len(ids_a), len(ids_b), ";".join(parts), len(parts), links))
        holders.update(set(links))
    best = {}
    for (x, _), n in holders.items():
        best[x] = max(best.get(x, 0), n)
    return [(doc_id, na, nb, ng, len(links), sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "") for doc_id, na, nb, text, ng, links in found]


_RANDOM = random.Random(5)
WORDS = ["the", "don't", "naïve", "Überraschung", "x<|endoftext|>y", "<s>", "12,345.67", "é", "字字字", "😀😀", "snake_case", "\t", "\n\n", " ", "a b", "\x00", "ﬁ"]
TEXTS = [None, "", " ", "  ", "a", " a", "a ", "a  b", "x ▁ y", "word ▁", "\n", "\x1c \x85 z", "aaaa " * 50, "one two\nthree  four \n five"]
TEXTS += [" ".join(_RANDOM.choices(WORDS, k=_RANDOM.randint(1, 40))) for _ in range(60)]
TEXTS += ["".join(_RANDOM.choices(WORDS, k=30)) for _ in range(10)] + ["ab" * 700, "the naïve 字 " * 90]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_whole_alignment_equals_the_plain_version(spark, tokenizers):
    rows = [*enumerate(TEXTS), (None, "null id here"), (5, "a  b"), (5, "a  b")]
    docs = spark.createDataFrame([(i, t, 9, "x", 1) for i, t in rows], "doc_id long, text string, block int, pairs string, n int")
    assert rows_of(alignment.align(docs.repartition(3))) == sorted(plain(rows, tokenizers), key=str)


def test_small_blocks_give_the_same(spark, tokenizers, monkeypatch):
    rows = list(enumerate(TEXTS))
    known = alignment.units_of("byte_bpe_50k.json", "piece_bpe_32k.model")
    expected = {d: h for d, *_, h in plain(rows, tokenizers)}
    for places, found in alignment._aligned(known, [t or "" for t in TEXTS]):
        for i, text in zip(places, found.group_texts(), strict=True):
            assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == expected[i]
    import pandas as pd
    batch = pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], "Int64"), "text": TEXTS})
    blocks = list(alignment._blocks(iter([batch, batch]), 500))
    assert len(blocks) > 5 and [i for ids, _ in blocks for i in ids] == 2 * list(range(len(TEXTS)))


def test_a_table_of_the_given_documents(spark, tokenizers, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 1500").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(plain(rows, tokenizers), key=str)


def test_nothing(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(alignment.align(only)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_give_the_digest(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    text = {r["doc_id"]: r["groups"] for r in alignment.groups(docs).collect()}
    for r in alignment.align(docs).collect():
        assert r["groups_sha256"] == (hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() if text[r["doc_id"]] else "")


def test_galloping_finds_ranks():
    rng = np.random.default_rng(3)
    held = np.unique(rng.integers(0, 5000, 900))
    sought = np.sort(rng.choice(np.arange(held[-1] + 1), 400, replace=False))
    low, high = np.zeros(400, np.int64), np.full(400, len(held))
    for guess in (low, high - 1, rng.integers(0, len(held), 400)):
        assert (alignment.gallop(sought, held, low, high, guess) == np.searchsorted(held, sought)).all()

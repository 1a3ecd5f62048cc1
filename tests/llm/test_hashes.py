"""Texts whose words differ but have equal letters at regular places, and long ones."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from letterscope.llm import near_dedup, packing, pretokens, textvec, token_counts


def doubling(n, a, b):
    """a b b a b a a b ...: each step appends the word with its letters exchanged."""
    word = a
    while len(word) < n:
        word += "".join(b if c == a else a for c in word)
    return word


WORDS = [doubling(n, *letters) for n in (1024, 2048, 4096) for letters in ("ab", "ba")]


def test_doubling_words_have_different_hashes():
    found, first = textvec.words(WORDS)
    assert len(set(found.tolist())) == len(WORDS) == first[-1]
    joined, starts, ends, hashes, checks, _ = pretokens.cut(WORDS)
    assert len(set(hashes.tolist())) == len(set(checks.tolist())) == len(WORDS)


@pytest.fixture(scope="module")
def word_docs(spark):
    return spark.createDataFrame(list(enumerate(WORDS)), "doc_id long, text string").coalesce(1)


def test_token_counts_and_ids_of_doubling_words(word_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [e.ids for e in tokenizer.encode_batch(WORDS, add_special_tokens=False)]
    counted = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(word_docs).collect()}
    assert [counted[i] for i in range(len(WORDS))] == [len(x) for x in ids]
    encoder = packing.ids_of("byte_bpe_50k.json", "<|endoftext|>")
    assert [x.tolist() for x in encoder.of(WORDS)] == ids


def test_doubling_words_are_not_near_duplicates(spark):
    docs = spark.createDataFrame([(i, f"{w} x y") for i, w in enumerate(WORDS)], "doc_id long, text string")
    assert all(r["kept"] for r in near_dedup.near_duplicates(docs, width=3, percent=85).collect())


def test_slices_longer_than_a_window_hash_alike_wherever_they_stand():
    word = ("abcdefg" * 60000).encode()
    raw = np.frombuffer(b"x " + word + b" yy " + word + b" z\n", np.uint8)
    starts, ends = textvec.word_places(raw, textvec._IS_SPACE)
    first, second = textvec.slice_hashes(raw, textvec.BYTE_VALUES, starts, ends, checks=True)
    assert first[1] == first[3] and second[1] == second[3] and len(set(first.tolist())) == 4


def test_a_remembered_piece_is_told_apart_by_its_second_hash():
    memory = pretokens.Memory(bits=6)
    same = np.array([5, 5, 5], np.uint64)
    memory.put(same[:1], np.array([1], np.uint64), np.array([10]))
    values, missing = memory.get(same, np.array([1, 2, 1], np.uint64))
    assert values[[0, 2]].tolist() == [10, 10] and missing.tolist() == [1]
    at, back = pretokens.distinct(same, np.array([1, 2, 1], np.uint64))
    assert len(at) == 2 and back[0] == back[2] != back[1]

"""The tree codec against the tiktoken library."""

import base64
import random

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbstream.llm import bpe
from llm_fixtures import make_docs, odd_texts  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def small(ranks):
    """Leaves of a few characters, so that short texts have deep trees."""
    return bpe.TreeCodec(ranks, PATTERN, leaf_chars=4, leaf_piece=3)


PARTS = ["a", "b", "'", "s", "re", " ", "  ", "\n", "\t", "1", "23", "é", "中", "!", "?!", "ll",
         "aaaa", "the ", "ing", "\u3000", "\xa0", "🙂", "\u0301", "ß", "½"]


def test_random_texts(small, library):
    chance = random.Random(7)
    for i in range(3000):
        text = "".join(chance.choice(PARTS) for _ in range(chance.randint(0, 60)))
        ids = library.encode_ordinary(text)
        assert small.encode(text).tolist() == ids, repr(text)
        assert small.decode(np.array(ids, np.int32)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(small, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert small.encode(text).tolist() == library.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=200))
def test_merge_of_any_bytes(small, library, data):
    assert small.merge(data) == library._encode_single_piece(data)


@pytest.mark.parametrize("text", [
    "a" * 5000, "ab" * 3000, " " * 5000 + "x", "1" * 4000, "!'" * 3000, "the" * 4000,
    "中文" * 2000, "\n" * 3000])
def test_long_pieces(ranks, small, library, text):
    assert small.encode(text).tolist() == library.encode_ordinary(text)
    assert bpe.TreeCodec(ranks, PATTERN).encode(text).tolist() == library.encode_ordinary(text)


def test_stable_pairs_are_whole_encodings(small, library):
    """The proof's criterion: all pairs stable means the ids are the encoding."""
    chance = random.Random(3)
    stable = 0
    for _ in range(3000):
        words = [chance.randrange(256, 3000) for _ in range(3)]
        if all(small.stable(a, b) for a, b in zip(words, words[1:])):
            stable += 1
            data = b"".join(small.bytes_of[i] for i in words)
            if all(small.merge(small.bytes_of[i]) == [i] for i in words):
                assert small.merge(data) == words
    assert stable > 100


def test_cache_starts_again_when_full(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    codec = bpe.TreeCodec(ranks, PATTERN)
    text = " ".join(f"word{i}" for i in range(100))
    assert codec.encode(text).tolist() == library.encode_ordinary(text)
    assert len(codec.cached) <= 5


def test_unknown_ids_are_an_error(small):
    with pytest.raises(ValueError):
        small.decode(np.array([10 ** 6], np.int32))


def test_digests(make_docs, odd_texts, library):
    rows = [*enumerate(odd_texts), (3, "again"), (3, "again"), (None, "no id")]
    got = bpe.encoding_digests(make_docs(rows, clashes=True), PATH, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids),
                     hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(make_docs):
    assert bpe.encoding_digests(make_docs([]), PATH, PATTERN).collect() == []


def test_rank_file_lines():
    line = base64.b64encode(b"ab") + b" 7\n"
    assert bpe.read_ranks(line + b"\n") == {b"ab": 7}

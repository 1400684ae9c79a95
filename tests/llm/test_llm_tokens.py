"""Token counts against the sentencepiece library on whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece

from kerbstream.llm import token_counts as tc
from llm_fixtures import make_docs, odd_texts  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


PARTS = ["a", " ", "  ", "    ", "the", "ing", "\n", "\t", "é", "中", "▁", "0", "12", ".", "Ⅳ", "🙂",
         "<s>", "</s>", "<unk>", "<0x0A>", "\u3000", "ﬁ", "x" * 9]


@pytest.mark.parametrize("part_chars", [1, 2, 5, 16])
def test_cut_texts_count_as_whole_ones(model, library, part_chars):
    counter = tc.PieceCounter(model, part_chars=part_chars, batch_bytes=64)
    assert counter.spaces_safe and counter.anchored
    chance = random.Random(part_chars)
    texts = ["".join(chance.choice(PARTS) for _ in range(chance.randint(0, 50)))
             for _ in range(700)]
    assert counter.counts(texts) == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("text", [
    "word " * 30_000, "x" * 60_000, " " * 60_000, "\n" * 60_000, "中文" * 30_000, "▁ " * 30_000,
    " lead and trail " * 5_000])
def test_long_texts(model, library, text):
    counter = tc.PieceCounter(model)
    assert counter.counts([text]) == [len(library.encode(text))]


def test_parts_are_bounded(model):
    counter = tc.PieceCounter(model, part_chars=100)
    parts = counter.parts("some words of text " * 1000)
    assert max(len(p) for p, _ in parts) <= 102


def test_operator(make_docs, odd_texts, library):
    rows = [*enumerate(odd_texts), (1, "again"), (1, "again"), (None, "no id")]
    got = tc.token_counts(make_docs(rows, clashes=True), PATH, 100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for doc_id, text in rows:
        n = len(library.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(make_docs):
    assert tc.token_counts(make_docs([]), PATH, 100).collect() == []

"""Lockstep alignment against a plain merge over the libraries' own tokens."""

import bisect
import collections
import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbstream.llm import alignment
from kerbstream.llm.common import file_bytes, prepare
from llm_fixtures import make_docs, odd_texts  # noqa: F401

os.environ["TOKENIZERS_PARALLELISM"] = "false"
A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


class Plain:
    """One text at a time, with the files' own libraries and dictionaries."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.bytes_of = alignment.byte_characters()

    def a_bytes(self, i):
        return bytes(self.bytes_of[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        """[(A ids, B ids)]"""
        if not text:
            return []
        data = f" {text}".encode()
        a = self.a.encode(f" {text}", add_special_tokens=False).ids
        b = self.b.encode(text)
        sides = [(a, [self.a_bytes(i) for i in a]), (b, [self.b_bytes(i) for i in b])]
        if any(b"".join(x) != data for _, x in sides):
            return []
        ends = [list(np.cumsum([len(x) for x in tokens])) for _, tokens in sides]
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for side, ((ids, _), until) in enumerate(zip(sides, ends)):
            for i, end in zip(ids, until):
                out[bisect.bisect_left(common, end)][side].append(i)
        return out

    def rows(self, docs):
        per_doc, documents = [], collections.Counter()
        for _, text in docs:
            groups = self.groups(text)
            links = collections.Counter((a, b) for x, y in groups for a in x for b in y)
            per_doc.append((groups, links))
            documents.update(links.keys())
        most = collections.Counter()
        for (a, _), n in documents.items():
            most[a] = max(most[a], n)
        out = []
        for (doc_id, _), (groups, links) in zip(docs, per_doc):
            written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((
                doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups),
                len(groups), sum(links.values()),
                sum(n for pair, n in links.items() if documents[pair] == most[pair[0]]),
                sum(n * documents[pair] for pair, n in links.items()),
                hashlib.sha256(written.encode()).hexdigest() if written else ""))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def small():
    """Short lanes and parts, so that short texts have many."""
    return alignment.Aligner(file_bytes(A_PATH), PATTERN, file_bytes(B_PATH), lane=3, part_chars=12)


def compare(aligner, plain, texts):
    n_a, n_b, n_groups, n_links, digests, pairs, links = (x.to_pylist() for x in aligner(texts))
    for i, text in enumerate(texts):
        groups = plain.groups(text)
        wanted = collections.Counter((a << 32) | b for x, y in groups for a in x for b in y)
        assert (n_a[i], n_b[i], n_groups[i], n_links[i]) == (
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
            sum(wanted.values())), repr(text)
        assert dict(zip(pairs[i], links[i])) == wanted, repr(text)
        assert len(pairs[i]) == len(wanted)
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert digests[i] == (hashlib.sha256(written.encode()).hexdigest() if written else "")


PARTS = ["a", "b", "'s", "re", " ", "  ", "\n", "\t", "1", "2300", "é", "中文", "!", "?!", "ll", "ſt",
         "aaaa", "the ", "ing", "　", "\xa0", "🙂", "́", "<|endoftext|>", "</s>", "<0x41>",
         "======", "        ", "ning", "tion of", "ﬁ", "\x00", "ภาษาไทย", "한국어"]


def test_random_texts(small, plain):
    chance = random.Random(3)
    texts = ["".join(chance.choice(PARTS) for _ in range(chance.randint(0, 40)))
             for _ in range(1500)]
    compare(small, plain, texts + [None, "", "holds ▁ itself", "▁"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_texts(small, plain, texts):
    compare(small, plain, [t.encode("utf-8", "ignore").decode() for t in texts])


def test_long_texts(plain, odd_texts):
    aligner = alignment.Aligner(file_bytes(A_PATH), PATTERN, file_bytes(B_PATH))
    chance = random.Random(5)
    long = " ".join("".join(chance.choice("aeioulmnrst") for _ in range(chance.randint(1, 9)))
                    for _ in range(20_000))
    compare(aligner, plain, [*odd_texts, long, "=" * 40_000, " " * 30_000, "中" * 9_000])


def test_every_token_of_the_vocabulary(plain):
    """The ranks give what the file's own merges give, for each token's text alone."""
    encoder = alignment.ByteEncoder(file_bytes(A_PATH), PATTERN)
    texts = [t.decode("utf-8", "ignore") for t in encoder.tokens]
    library = plain.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)
    assert all(encoder.encode(t).tolist() == x.ids for t, x in zip(texts, library))


def test_steps_are_bounded_by_the_lane():
    """One text of 100,000 tokens that agree takes no more steps than a lane has tokens."""
    ends = np.arange(1, 100_001)
    starts = np.array([0, 100_000])
    a, b, stop = alignment.lanes(ends, ends, starts, starts)
    assert a.tolist() == b.tolist() and (stop - a).max() <= alignment.LANE
    assert len(alignment.cuts(ends, ends, a, b, stop)) == 100_000


def test_large_groups_are_counted():
    a, b = np.array([1] * 300 + [2] * 200), np.array([7] * 400 + [8])
    groups = np.array([[0, 500, 0, 401]])
    owner, pairs, links = alignment.linked_pairs(groups, np.array([4]), a, b)
    assert owner.tolist() == [4] * 4
    assert pairs.tolist() == [(1 << 32) + 7, (1 << 32) + 8, (2 << 32) + 7, (2 << 32) + 8]
    assert links.tolist() == [120_000, 300, 80_000, 200]


@pytest.mark.parametrize("broadcast_pairs", [0, 5, 40, 1 << 19])
def test_counts(spark, make_docs, odd_texts, plain, broadcast_pairs):
    """Whether pairs are all broadcast, some, or none."""
    prepare(spark)
    chance = random.Random(9)
    docs = [*enumerate(odd_texts), (None, "the end"), (3, "the end"), (3, "the end"),
            *[(100 + i, "".join(chance.choice(PARTS) for _ in range(12))) for i in range(60)]]
    found = alignment.alignments_with_counts(
        make_docs(docs, clashes=True), A_PATH, PATTERN, B_PATH, broadcast_pairs=broadcast_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                             "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain.rows(docs)


def test_odd_columns_and_no_rows(spark, make_docs):
    prepare(spark)
    docs = make_docs([(1, "a b"), (2, None)])
    odd = docs.withColumnsRenamed({"lang": "a.b", "source": "Pairs"})
    rows = [alignment.alignments_with_counts(d, A_PATH, PATTERN, B_PATH).orderBy("doc_id").collect()
            for d in (docs, odd)]
    assert rows[0] == rows[1] and rows[0][1][1:-1] == (0,) * 6
    empty = make_docs([(1, "a")]).limit(0)
    assert alignment.alignments_with_counts(empty, A_PATH, PATTERN, B_PATH).collect() == []

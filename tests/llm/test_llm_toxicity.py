"""The pattern grammar against its machines run one after the other, learning on planted words, and
held-out accuracy on the supplied labels."""

import os
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import TESTDATA
from kerbstream.llm import toxicity
from kerbstream.llm.common import prepare
from kerbstream.llm.toxicity import MARK_BITS, MATCH, Grammar, Model
from llm_fixtures import make_docs, odd_texts  # noqa: F401

DIRECTED, REPORTED, NEGATED, THREAT = (
    MARK_BITS[m] for m in ("directed", "reported", "negated", "threat"))


@pytest.fixture(scope="module")
def grammar():
    return Grammar(Model())


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(toxicity.INPUTS), max_size=40))
def test_composition_is_the_cascade(symbols):
    """The composed machine writes what the machines write when each reads all that the one
    before it wrote."""
    stream = [*symbols, toxicity.BREAK]
    for step, state in toxicity.CASCADE:
        written = []
        for symbol in stream:
            state, out = step(state, symbol)
            written += out
        stream = written
    state, found = 0, []
    for symbol in [*symbols, toxicity.BREAK]:
        state, out = toxicity.composed()[state][symbol]
        found += out
    assert found == stream


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(toxicity.INPUTS), max_size=40))
def test_each_insult_is_matched_once(symbols):
    state, found = 0, []
    for symbol in [*symbols, toxicity.BREAK]:
        state, out = toxicity.composed()[state][symbol]
        found += out
    matches = [s - MATCH for s in found if s >= MATCH]
    assert sum(not kind & THREAT for kind in matches) == symbols.count(toxicity.INSULT)
    assert sum(bool(kind & THREAT) for kind in matches) <= symbols.count(toxicity.THREAT)


@pytest.mark.parametrize("text, kinds", [
    ("You are an idiot.", [DIRECTED]),
    ("Idiot! The whole day.", [0]),
    ("IDIOTS, all of you", [DIRECTED]),
    ("He is not an idiot.", [NEGATED | DIRECTED]),
    ("That isn't stupid at all", [NEGATED]),
    ('She wrote "you idiot" and left.', [DIRECTED | REPORTED]),
    ("“trash” stood on the wall", [REPORTED]),
    ("I will kill you!", [THREAT | DIRECTED]),
    ("we'll burn the house", [THREAT]),
    ("kill you", [THREAT | DIRECTED]),
    ("the kill switch", []),
    ("skill and idiotic antiidiot", [0]),
    ("not here. trash there", [0]),
    ("idiot moron; the end", [0, 0]),
    ("du bist kein Trottel", [NEGATED | DIRECTED]),
])
def test_marks(grammar, text, kinds):
    assert [k for c in grammar.clauses(text) for k in c.kinds] == kinds


def test_spans_and_weights(grammar):
    text = "Fine.\nİ say it: what a day; you idiot, you moron! Fine, trash."
    clauses = grammar.clauses(text)
    assert [text[c.start:c.end] for c in clauses] == ["you idiot, you moron", "Fine, trash"]
    weights = [grammar.weight(c) for c in clauses]
    assert weights[0] > weights[1] == toxicity.INSULT_RATIO
    plain, negated = (grammar.clauses(t)[0] for t in ("an idiot", "not an idiot"))
    assert grammar.weight(plain) > grammar.weight(negated)


def test_only_lines_with_a_form_are_read(grammar):
    lower = "\n".join(["word " * 500] * 200 + ["an idiot here"] + ["word " * 500] * 200)
    assert [lower[a:b] for a, b in grammar.lines(lower)] == ["an idiot here"]


def planted(chance, toxic, stem="blorg"):
    words = ["".join(chance.choice("aeiklmnort") for _ in range(chance.randint(2, 7)))
             for _ in range(60)]
    if toxic:
        for _ in range(4):
            words.insert(chance.randint(0, 60), stem + chance.choice(["", "en", "ach", "i"]))
    return " ".join(words) + "."


def labelled(spark, make_docs, n=400, noise=()):
    chance = random.Random(4)
    toxic = {i: i % 5 == 0 for i in range(n)}
    docs = [(i, planted(chance, toxic[i])) for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in toxic.items()],
                                   "doc_id long, quality int, toxic int")
    return docs, toxic, labels


def test_learns_planted_words(spark, make_docs, odd_texts):
    prepare(spark)
    docs, toxic, labels = labelled(spark, make_docs)
    extra = [(10_000 + i, t) for i, t in enumerate(odd_texts)] + [
        (None, "blorgen blorgi blorg blorg"), (7, "no"), (7, "no"), (7, None)]
    table = make_docs([*docs, *extra], clashes=True)
    table = table.withColumnsRenamed({"rate": "a.b", "kept": "Score"}).withColumn("score_", F.lit(1))
    rows = toxicity.judged_documents(table, labels).collect()
    assert len(rows) == len(docs) + len(extra)
    for row in rows:
        assert row.held_out == (row.doc_id is not None
                                and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        if row.doc_id is not None and row.doc_id < 400 and row.doc_id != 7:
            assert bool(row.predicted) == toxic[row.doc_id]
        if row.doc_id is not None and row.doc_id >= 10_000:
            assert row.predicted == 0 and row.matched_clauses == 0
    assert [r.predicted for r in rows if r.doc_id is None] == [1]


def test_held_out_labels_teach_nothing(spark, make_docs):
    prepare(spark)
    docs, toxic, labels = labelled(spark, make_docs)
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    table = make_docs(docs)
    assert toxicity.learned(table, labels) == toxicity.learned(table, flipped)


def test_words_of_copies_are_not_learned(spark, make_docs):
    """A toxic text copied many times: its other words stand in as many toxic texts."""
    prepare(spark)
    docs, toxic, labels = labelled(spark, make_docs)
    copy = "zzymurg quaxlo vrimple blorg blorgen vrimple, blorgach zzymurg blorgi."
    docs += [(1000 + i, copy) for i in range(100)]
    labels = labels.unionByName(spark.createDataFrame(
        [(1000 + i, 1, 1) for i in range(100)], labels.schema))
    lexicon = toxicity.learned(make_docs(docs), labels).lexicon
    assert any(form.startswith("blorg") or "blorg".startswith(form) for form in lexicon)
    assert not any(form[:3] in ("zzy", "qua", "vri") for form in lexicon)


def test_sample_is_bounded_whatever_repeats(spark, make_docs):
    """One id with most rows, and many equal rows."""
    prepare(spark)
    docs, toxic, labels = labelled(spark, make_docs)
    docs += [(5, f"other text {i}") for i in range(500)] + [(10, "same text")] * 500
    texts = toxicity.training_texts(make_docs(docs), labels, sample=50)
    sizes = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    assert sizes[True] <= 50 and sizes[False] <= 50
    assert texts.filter(F.col("text") == "same text").count() <= 1


@pytest.mark.parametrize("values", [[], [0], [1], [None]])
def test_without_labels_of_both_kinds(spark, make_docs, values):
    prepare(spark)
    docs = make_docs([(1, "you idiot, you stupid moron"), (2, "a fine day"), (3, None)])
    labels = spark.createDataFrame([(1, 1, v) for v in values], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.judged_documents(docs, labels).orderBy("doc_id").collect()] \
        == [1, 0, 0]
    assert toxicity.judged_documents(docs.limit(0), labels).collect() == []


def test_of_several_labels_toxic_counts(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 1, None), (3, 1, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    texts = toxicity.training_texts(make_docs([(1, "a"), (3, "b"), (None, "c")]), labels)
    assert sorted(map(tuple, texts.collect())) == [("a", True, 1.0), ("b", False, 1.0)]


def test_accuracy_on_held_out_documents(spark):
    prepare(spark)
    folder = os.path.join(TESTDATA, "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = toxicity.judged_documents(docs, labels).join(labels, "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    # Six toxic ones of these hold no toxic word at all.
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.92 and n.get((0, 1), 0) / n[0, 0] < 0.005

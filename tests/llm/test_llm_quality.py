"""Statistics against slow definitions, and estimates against data made to have outliers."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from kerbstream.llm import quality as q
from llm_fixtures import make_docs, odd_texts  # noqa: F401


def slow_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines)
              if line in lines[:i] and re.search(r"[^\x20\x09-\x0D]", line))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat))


TEXTS = ["a b c a b c", "x\nx\n\n\nx y\nx", "#*$%&|<>", "é é é é 中 🙂 🙂 🙂 🙂", "\x1c\x85 a\x0bb\x0cc",
         "one two three four\none two three\n \n ", "a a a", "a a", "A\r\nA\r\nb"]


def test_statistics(odd_texts):
    for text in [*odd_texts, *TEXTS]:
        data = None if text is None else text.encode()
        assert q.text_statistics(data)[:5] == slow_statistics(text), repr(text)[:80]


def prose(chance, n=80):
    return " ".join("".join(chance.choice(list("abcdefghij"), 5)) for _ in range(n)) + "."


def junk(chance):
    return " ".join("".join(chance.choice(list("abcdefghij"), 5)) + "###" for _ in range(80))


@pytest.fixture(scope="module")
def corpus(make_docs):
    chance = np.random.default_rng(1)
    rows, bad = [], set()
    for i in range(900):
        lang, source = ("en", "big") if i % 3 else ("de", f"s{i % 2}")
        odd = i % 10 == 0
        rows.append((i, junk(chance) if odd else prose(chance), lang, source))
        bad |= {i} if odd else set()
    rows += [(2000, "too short", "en", "big"), (2001, "a b c " * 40, "en", "big"), (2002, None),
             (2003, ""), (None, prose(chance), None, "big"), (5, prose(chance), "en", "big"),
             (2005, prose(chance), "xx", "lonely"),
             (2006, " ".join(["y" * 50_000, *(f"z{i}" for i in range(60))]), "en", "big")]
    return rows, bad


def test_rejects_outliers_and_keeps_the_rest(make_docs, corpus):
    rows, bad = corpus
    got = q.judged_documents(make_docs(rows, clashes=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (2000, 2001, 2002, 2003):
            assert r.base_failed and not r.kept
        elif r.doc_id == 2006:
            assert not r.base_failed and not r.kept
        else:
            assert not r.base_failed and r.kept == (r.doc_id not in bad), r


def test_stage_keeps_the_kept_rows_whole(make_docs, corpus):
    rows, bad = corpus
    docs = make_docs(rows, clashes=True)
    kept = q.kept_documents(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    gone = bad | {2000, 2001, 2002, 2003, 2006}
    want = Counter((d, t) for d, t, *_ in rows if d not in gone)
    assert Counter((r.doc_id, r.text) for r in out) == want


def test_estimate_is_not_pulled_by_outliers(spark):
    chance = np.random.default_rng(3)
    clean = chance.normal(0.5, 0.4, (1600, q.SIZE))
    wild = chance.normal(9.0, 0.1, (320, q.SIZE))
    data = [("g", *map(float, row)) for row in np.concatenate([clean, wild])]
    data += [("h", *map(float, row)) for row in chance.normal(-3, 0.2, (500, q.SIZE))]
    rows = spark.createDataFrame(data, ["group", *q.VECTOR])
    got = {r.group: r for r in q.robust_estimates(rows).collect()}
    assert np.allclose(got["g"].mean, 0.5, atol=0.08)
    assert np.allclose(got["h"].mean, -3, atol=0.05)
    root = np.zeros((q.SIZE, q.SIZE))
    root[np.tril_indices(q.SIZE)] = got["g"].root
    covariance = np.linalg.inv(root.T @ root) - np.diag(np.square(list(q.FLOORS.values())))
    assert np.allclose(np.sqrt(np.diag(covariance)), 0.4, atol=0.08)


def test_the_determinant_never_grows(spark):
    chance = np.random.default_rng(4)
    data = [("g", *map(float, row)) for row in chance.standard_t(2, (800, q.SIZE))]
    rows = spark.createDataFrame(data, ["group", *q.VECTOR]).cache()
    now = q._concentrated(rows, q._start(rows)).cache()
    logs = [now.first().logdet]
    for _ in range(3):
        now = q._concentrated(rows, now).cache()
        logs.append(now.first().logdet)
    assert all(b <= a + 1e-3 for a, b in zip(logs, logs[1:])), logs


def test_constants():
    # chi-square quantiles from published tables
    assert abs(q._quantile(0.95, 6) - 12.592) < 1e-3
    assert abs(q._quantile(0.999, 6) - 22.458) < 1e-3


def slow_shrunk(levels):
    """Each estimate drawn to the one before it, by documents; ``levels`` from the widest."""
    mean = levels[0][1]
    covariance = np.diag(np.square(list(q.PRIOR.values())))
    for n, own_mean, own_covariance in levels:
        mean = (n * own_mean + q.TRUST * mean) / (n + q.TRUST)
        covariance = (n * own_covariance + q.TRUST * covariance) / (n + q.TRUST)
    return mean, covariance


def test_small_groups_are_drawn_to_wider_ones(spark):
    """The judging estimate of every language and source against the formula, from estimates of
    each group alone."""
    chance = np.random.default_rng(8)
    groups = {("en", "a"): 300, ("en", "b"): 20, ("de", "a"): 3, ("de", None): 1, (None, "a"): 2}
    data = [(lang, source, False, *map(float, row)) for (lang, source), n in groups.items()
            for row in chance.normal(len(str(lang)), 0.3, (n, q.SIZE))]
    described = spark.createDataFrame(
        data, "lang string, source string, base_failed boolean, "
        + ", ".join(f"{name} double" for name in q.VECTOR))
    got = {(r._lang, r._source): r for r in q.fitted(described).collect()}
    assert set(got) == set(groups)

    def alone(choose):
        rows = [("g", *r[3:]) for r in data if choose(*r[:2])]
        found = q.robust_estimates(spark.createDataFrame(rows, ["group", *q.VECTOR])).first()
        return found.n, np.array(found.mean), q._whole(found.covariance)

    everything = alone(lambda lang, source: True)
    for lang, source in groups:
        mean, covariance = slow_shrunk([
            everything, alone(lambda x, _: x == lang), alone(lambda x, y: (x, y) == (lang, source))])
        assert np.allclose(got[lang, source].mean, mean, atol=1e-6)
        root = np.zeros((q.SIZE, q.SIZE))
        root[np.tril_indices(q.SIZE)] = got[lang, source].root
        assert np.allclose(np.linalg.inv(root.T @ root), covariance + q._FLOOR, atol=1e-6)


def test_the_estimate_is_near_the_smallest_determinant(spark):
    """Against every core of small groups, of which some are outliers."""
    chance = np.random.default_rng(12)
    for outliers in (0, 1, 2, 3):
        values = chance.normal(0, 0.5, (12, q.SIZE))
        values[:outliers] += 6
        rows = spark.createDataFrame([("g", *map(float, v)) for v in values], ["group", *q.VECTOR])
        found = q.robust_estimates(rows).first()
        cores = []
        for core in itertools.combinations(range(12), 9):
            part = values[list(core)]
            covariance = q.SCALE * np.cov(part.T, bias=True) + q._FLOOR
            cores.append(np.linalg.slogdet(covariance)[1])
        # Bins take the last document of a core in part, so a core need not be whole documents.
        assert found.logdet <= np.quantile(cores, 0.2), outliers
        assert found.logdet >= min(cores) - 1.5
        if outliers:
            assert np.abs(found.mean).max() < 1


def test_steps_end_where_another_would_not_better(spark):
    chance = np.random.default_rng(5)
    data = [(g, *map(float, row)) for g in ("g", "h") for row in chance.standard_t(2, (300, q.SIZE))]
    rows = spark.createDataFrame(data, ["group", *q.VECTOR])
    now = q.robust_estimates(rows)
    after = {r.group: r.logdet for r in q._concentrated(rows, now).collect()}
    assert all(after[r.group] >= r.logdet - q.SETTLED for r in now.collect())


def test_a_small_table_is_judged(make_docs):
    """Junk of rare groups goes, though each group has few documents and no table-wide pool."""
    chance = np.random.default_rng(6)
    rows = [(i, prose(chance), "en", f"s{i % 30}") for i in range(70)]
    rows += [(100 + i, junk(chance), "de" if i % 2 else None, f"j{i}") for i in range(12)]
    got = q.judged_documents(make_docs(rows)).collect()
    assert all(r.distance is not None for r in got)
    assert {r.doc_id for r in got if not r.kept} == {100 + i for i in range(12)}


def test_few_documents_are_judged_by_the_prior(make_docs):
    chance = np.random.default_rng(2)
    got = q.judged_documents(make_docs([(1, prose(chance)), (2, prose(chance))])).collect()
    assert all(r.kept and r.distance is not None for r in got)


def headed(chance, lines, repeated):
    """Lines of prose of which ``repeated`` are one and the same."""
    same = prose(chance, 12)
    return "\n".join([prose(chance, 12) for _ in range(lines - repeated)] + [same] * repeated)


def test_repetition_alone_rejects(make_docs):
    """Texts like all others but for repeated lines; a heading that stands twice is nothing."""
    chance = np.random.default_rng(7)
    rows = [(i, headed(chance, 20, 0), "en", "s") for i in range(300)]
    rows += [(1000, headed(chance, 20, 2), "en", "s"), (1001, headed(chance, 20, 10), "en", "s")]
    got = {r.doc_id: r for r in q.judged_documents(make_docs(rows)).collect()}
    assert got[1000].kept and got[5].kept
    assert not got[1001].base_failed and not got[1001].kept
    assert got[1001].word_length == pytest.approx(got[5].word_length, abs=0.1)


def test_any_column_names(make_docs):
    chance = np.random.default_rng(9)
    docs = make_docs([(i, prose(chance), "en", "s") for i in range(20)] + [(90, "short")])
    odd = docs.withColumnRenamed("n_chars", "a.b`c").withColumn("mean", docs.text).withColumn(
        "distance", docs.text).withColumn("_lang", docs.text)
    kept = q.kept_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 20


def test_empty_table(make_docs):
    assert q.judged_documents(make_docs([])).collect() == []
    assert q.kept_documents(make_docs([])).collect() == []

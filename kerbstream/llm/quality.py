"""Quality rules with robust multivariate outliers.

First two fixed rules fail a document: fewer than ``MIN_WORDS`` words, or more than
``MAX_REPEATED_PERCENT`` percent of its words in repeated 3-word windows. All others are judged
by how unusual their statistics are together. The statistics are transformed to be roughly
symmetric, and for each language and source a minimum-covariance-determinant estimate gives
a mean and covariance that outliers cannot pull: those of the ``CORE`` share of documents whose
covariance has the smallest determinant. A document goes if its squared Mahalanobis distance from
its group's estimate is above ``CUTOFF``.

The estimate is found by concentration steps over all documents. A step bins the documents by
distance, sums moments per group and bin, and takes the bins up to the core share (the last in
part), whose moments give the next estimate, if its determinant is smaller. Steps go on until no
group's determinant shrinks any more; as it is bounded from below, they end. Each task sends one
row per group and bin, however many documents a group has. The table of estimates stays a table.

Estimates of few documents say little, so each is drawn to a wider one, by one formula for all
sizes: with n documents, n / (n + ``TRUST``) of an estimate is a group's own, and the rest is that of
its language, which is drawn to that of all documents in the same way, and that to ``PRIOR``, wide
spreads around its own mean. Every document is judged.

Statistics that hardly vary in a group (no symbols in any text, say) would make any document that
differs infinitely unusual, so ``FLOORS`` are added to the standard deviations. They are a few times
the spreads within a language, and small enough for any one statistic to reject a document alone.

Defined cases: null and empty texts have no words and fail; a null language or source is a value
like any other; repeated rows count once each; documents that tie are judged alike; a very long text
is one document, read whole by one task; an empty table gives an empty result. ``kept_documents``
returns the table's own columns, whatever their names; ``judged_documents`` returns its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.llm.common import map_texts, whole_row
from kerbstream.session import materialise

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

CORE = 0.75
TRUST = 100  # documents that weigh as much as the wider estimate
SETTLED = 1e-3  # change of a log determinant
BINS_PER_DOUBLING = 4

# The judged vector, with what is added to each standard deviation.
FLOORS = {
    "word_length": 0.10,  # log of characters per word
    "symbol_rate": 0.05,  # square roots of shares from here on
    "mark_rate": 0.07,
    "capital_rate": 0.10,
    "dup_line_rate": 0.14,
    "repeat_rate": 0.14,
}
# Spreads before any document is seen.
PRIOR = {"word_length": 0.30, "symbol_rate": 0.10, "mark_rate": 0.15, "capital_rate": 0.20,
         "dup_line_rate": 0.20, "repeat_rate": 0.20}
# A heading of three words that stands twice is nothing odd.
USUAL_DUP_LINES, USUAL_REPEAT_WORDS = 1, 6
VECTOR = list(FLOORS)
SIZE = len(VECTOR)

BASE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
MORE = "n_lines long, n_marks long, n_capitals long"

_BYTES = np.arange(256)
_IS_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_IS_INNER = (_BYTES & 0xC0) == 0x80  # bytes of a code point after its first
_IS_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_IS_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_IS_MARK = ((_BYTES > 32) & (_BYTES < 127) & ~((_BYTES >= 48) & (_BYTES <= 57))
            & ~_IS_CAPITAL & ~((_BYTES >= 97) & (_BYTES <= 122)))


# ---- statistics -----------------------------------------------------------------------------

def text_statistics(data: bytes | None) -> tuple[int, ...]:
    """The columns of ``BASE`` and ``MORE`` for a UTF-8 text. Marks are ASCII punctuation,
    capitals are A-Z."""
    data = data or b""
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    spaces = int(seen[_IS_SPACE].sum())
    return (len(words), len(data) - int(seen[_IS_INNER].sum()) - spaces,
            int(seen[_IS_SYMBOL].sum()), *_lines(data), _repeated_words(words),
            data.count(b"\n") + 1, int(seen[_IS_MARK].sum()), int(seen[_IS_CAPITAL].sum()))


def _lines(data: bytes) -> tuple[int]:
    seen, repeated = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            repeated += bool(line.strip())
        seen.add(line)
    return (repeated,)


def _repeated_words(words: list[bytes]) -> int:
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, covered = Counter(windows), bytearray(len(words))
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered[i:i + 3] = b"\1\1\1"
    return sum(covered)


def _statistics_batch(texts: list[bytes | None]) -> list[list[int]]:
    rows = [text_statistics(t) for t in texts]
    return [list(c) for c in zip(*rows)] if rows else [[]] * 8


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def _vector() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    beyond = lambda name, usual: F.greatest(F.col(name) - usual, F.lit(0))
    return {
        "word_length": F.log(chars / words),
        "symbol_rate": F.sqrt(F.col("n_symbols") / chars),
        "mark_rate": F.sqrt(F.col("n_marks") / chars),
        "capital_rate": F.sqrt(F.col("n_capitals") / chars),
        "dup_line_rate": F.sqrt(beyond("n_dup_lines", USUAL_DUP_LINES) / F.col("n_lines")),
        "repeat_rate": F.sqrt(beyond("n_repeat_words", USUAL_REPEAT_WORDS) / words),
    }


# ---- groups ---------------------------------------------------------------------------------

def _name(*parts: str) -> Column:
    return F.to_json(F.array(*[F.lit(p) if p in ("all", "language", "own") else F.col(p)
                               for p in parts]), {"ignoreNullFields": "false"})


ALL, LANGUAGE, OWN = ("all",), ("language", "lang"), ("own", "lang", "source")


# ---- estimates ------------------------------------------------------------------------------

def _distance() -> Column:
    """Squared length of root * (x - mean), root being lower triangular, row by row."""
    off = [F.col(name) - F.col("mean")[i] for i, name in enumerate(VECTOR)]
    total = None
    for i in range(SIZE):
        z = None
        for j in range(i + 1):
            term = F.col("root")[i * (i + 1) // 2 + j] * off[j]
            z = term if z is None else z + term
        total = z * z if total is None else total + z * z
    return total


def _moments() -> list[Column]:
    first = [F.sum(name) for name in VECTOR]
    second = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(VECTOR) for b in VECTOR[:i + 1]]
    return [m.alias(f"m{i}") for i, m in enumerate(first + second)]


_N_MOMENTS = SIZE + SIZE * (SIZE + 1) // 2
_ESTIMATE = ("group string, n long, mean array<double>, covariance array<double>, "
             "root array<double>, logdet double")


def _chi_square(x: float, dof: int) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half ** k / math.factorial(k) for k in range(dof // 2))


def _quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, dof) < p else (low, middle)
    return low


# A core's covariance is too small for the whole; this makes it right for normal data.
SCALE = CORE / _chi_square(_quantile(CORE, SIZE), SIZE + 2)
# One in a thousand of normal data is further away.
CUTOFF = _quantile(1 - 1e-3, SIZE)


def _root(covariance: np.ndarray) -> tuple[list[float], float]:
    """Inverse Cholesky factor, packed by rows, and the log determinant."""
    factor = np.linalg.cholesky(covariance)
    inverse = np.linalg.inv(factor)
    return (inverse[np.tril_indices(SIZE)].tolist(),
            2 * float(np.log(np.diag(factor)).sum()))


_FLOOR = np.diag(np.square(list(FLOORS.values())))
_LOWER = np.tril_indices(SIZE)


def _whole(packed) -> np.ndarray:
    """A symmetric matrix from its lower half by rows."""
    out = np.zeros((SIZE, SIZE))
    out[_LOWER] = packed
    return out + np.tril(out, -1).T


def _estimate_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of the core, one row per group, to mean, covariance, root and determinant."""
    for batch in batches:
        rows = []
        for group, documents, n, *m in batch.itertuples(index=False):
            mean = np.array(m[:SIZE]) / n
            covariance = SCALE * (_whole(np.array(m[SIZE:]) / n) - np.outer(mean, mean))
            root, logdet = _root(covariance + _FLOOR)
            rows.append((group, documents, mean.tolist(), covariance[_LOWER].tolist(), root, logdet))
        yield pd.DataFrame(rows, columns=[
            "group", "n", "mean", "covariance", "root", "logdet"])


def _start(rows: DataFrame) -> DataFrame:
    """Medians and interquartile ranges per group, as a first mean and diagonal."""
    quartiles = rows.groupBy("group").agg(F.count("*").alias("n"), *[
        F.percentile_approx(name, [0.25, 0.5, 0.75], 1000).alias(name) for name in VECTOR])
    spread = [F.sqrt(F.pow((F.col(name)[2] - F.col(name)[0]) / 1.349, 2) + FLOORS[name] ** 2)
              for name in VECTOR]
    pairs = [(i, j) for i in range(SIZE) for j in range(i + 1)]
    zero = F.lit(0.0)
    return quartiles.select(
        "group", "n", F.array(*[F.col(name)[1] for name in VECTOR]).alias("mean"),
        F.array(*[spread[i] ** 2 if i == j else zero for i, j in pairs]).alias("covariance"),
        F.array(*[1 / spread[i] if i == j else zero for i, j in pairs]).alias("root"),
        F.lit(float("inf")).alias("logdet"))


def _concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step for all groups."""
    placed = rows.join(estimate.select("group", "mean", "root"), "group")
    octave = F.log2(_distance() + F.lit(1e-9)) * BINS_PER_DOUBLING
    bins = placed.withColumn("bin", F.floor(octave).cast("int")).groupBy("group", "bin").agg(
        F.count("*").alias("n"), *_moments())
    in_order = Window.partitionBy("group").orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("group")
    upto = bins.withColumns({"upto": F.sum("n").over(in_order), "all": F.sum("n").over(whole)})
    part = F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), (F.lit(CORE) * F.col("all") - (F.col("upto") - F.col("n"))) / F.col("n")))
    names = ["n", *[f"m{i}" for i in range(_N_MOMENTS)]]
    core = upto.withColumn("part", part).groupBy("group").agg(
        F.max("all").alias("documents"),
        *[F.sum(F.col(name) * F.col("part")).alias(name) for name in names])
    return core.mapInPandas(_estimate_rows, _ESTIMATE)


def robust_estimates(rows: DataFrame, settled: float = SETTLED) -> DataFrame:
    """(group, n, mean, covariance, root, logdet) of all documents in ``rows`` (group and the
    vector). A group takes a step's estimate only if that makes its determinant smaller, so the
    steps end, and at an estimate that one more step would not better. One number per step
    reaches the driver."""
    now = materialise(_start(rows), "estimate")
    while True:
        old = now.select("group", *[F.col(c).alias(f"old_{c}") for c in now.columns[1:]])
        better = F.col("logdet") < F.col("old_logdet") - settled
        after = materialise(_concentrated(rows, now).join(old, "group").select(
            "group", *[F.when(better, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
                       for c in now.columns[1:]], better.alias("better")), "estimate")
        now = after.drop("better")
        if not after.filter("better").limit(1).count():
            return now


def shrunk(n: float, mean, covariance, wide_mean, wide_covariance) -> tuple[np.ndarray, np.ndarray]:
    """An estimate of n documents, drawn to a wider one."""
    own = n / (n + TRUST)
    return (own * np.asarray(mean) + (1 - own) * np.asarray(wide_mean),
            own * np.asarray(covariance) + (1 - own) * np.asarray(wide_covariance))


def _shrunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each language and source: its estimate drawn to its language's, that to the one of all
    documents, and that to the prior."""
    prior = np.diag(np.square(list(PRIOR.values())))[_LOWER]
    for batch in batches:
        rows = []
        for r in batch.to_dict("records"):
            wide = r["mean_all"], prior
            for kind in ("_all", "_language", ""):
                wide = shrunk(r[f"n{kind}"], r[f"mean{kind}"], r[f"covariance{kind}"], *wide)
            root, _ = _root(_whole(wide[1]) + _FLOOR)
            rows.append((r["_lang"], r["_source"], r["group"], wide[0].tolist(), root))
        yield pd.DataFrame(rows, columns=["_lang", "_source", "group", "mean", "root"])


# ---- the operator ---------------------------------------------------------------------------

def _described(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        _vector() | {"base_failed": base_failed(F.col("n_words"), F.col("n_repeat_words"))})


def fitted(described: DataFrame) -> DataFrame:
    """(_lang, _source, group, mean, root): what the documents of each language and source are
    judged by."""
    passed = described.filter(~F.col("base_failed")).select("lang", "source", *VECTOR)
    # The steps read nothing but groups and vectors; a document is in a group of each kind.
    kinds = F.explode(F.array(*[_name(*parts) for parts in (ALL, LANGUAGE, OWN)]))
    vectors = materialise(passed.select(kinds.alias("group"), *VECTOR), "vectors")
    found = robust_estimates(vectors).select("group", "n", "mean", "covariance")
    groups = materialise(passed.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        _name(*OWN).alias("group"), _name(*LANGUAGE).alias("_in")).distinct(), "groups")

    def named(suffix: str) -> DataFrame:
        return found.select(F.col("group").alias(f"group{suffix}"), *[
            F.col(c).alias(f"{c}{suffix}") for c in ("n", "mean", "covariance")])

    everything = F.broadcast(named("_all").filter(F.col("group_all") == '["all"]'))  # one row
    joined = (groups.join(found, "group")
              .join(named("_language"), F.col("_in") == F.col("group_language"))
              .join(everything, F.lit(True)))
    return materialise(joined.mapInPandas(
        _shrunk_rows, "_lang string, _source string, group string, mean array<double>, "
        "root array<double>"), "shrunk")


def judged(described: DataFrame, estimates: DataFrame) -> DataFrame:
    """``described`` with group, distance and kept."""
    placed = described.join(
        estimates, F.col("lang").eqNullSafe(F.col("_lang"))
        & F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "distance", _distance())
    # No estimate is there only for groups of which no document passes the fixed rules.
    kept = ~F.col("base_failed") & (F.col("distance") <= CUTOFF)
    return placed.withColumn("kept", kept).drop("_lang", "_source", "mean", "root")


def _measured(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return map_texts(docs, keep, text, f"{BASE}, {MORE}", _statistics_batch, binary=True)


def judged_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, source, the statistics, base_failed, distance and kept of each document."""
    described = materialise(
        _described(_measured(docs, text, ["doc_id", "lang", "source"])), "statistics")
    return judged(described, fitted(described))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that fail.

    The statistics are taken twice, to fit and to judge, so that no copy of the texts is written.
    Documents are judged where they lie, by the table of estimates; texts are not shuffled
    unless that table is too large to broadcast.
    """
    slim = materialise(_described(_measured(docs, text, ["lang", "source"])), "statistics")
    estimates = fitted(slim)
    whole = docs.select(whole_row(docs).alias("row"), F.col("lang"), F.col("source"),
                        F.col(text).cast("binary").alias("text"))
    measured = whole.select("row", "lang", "source", _statistics_of()("text").alias("s"))
    described = _described(measured.select("row", "lang", "source", "s.*"))
    return judged(described, estimates).filter("kept").select("row.*")


def _statistics_of():
    fields = T.StructType.fromDDL(f"{BASE}, {MORE}")

    @F.arrow_udf(fields)
    def of(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in _statistics_batch(texts.to_pylist())], fields.names)

    # Else Spark would move part of the filter below it and evaluate it once more for that.
    return of.asNondeterministic()

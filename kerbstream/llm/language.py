"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. For every bit a binary classifier over byte n-grams
says whether a text's language has +1 there. The predicted language is the one whose codeword is
nearest to the classifiers' margins under loss-weighted decoding: the sum over bits of the
logistic loss of (codeword bit * margin), weighted by how often that bit was right for that
language on the training texts. Codewords differ in several bits, so a few wrong bits do no harm.

A text whose best two languages are too close is flagged as ambiguous. Margins are means over
n-grams, so those of a text in two languages lie on the line between the two languages' typical
margins, the means of their training texts, as far along it as the text is divided. A text is
flagged if less than ``BETWEEN`` of the way, or of the belief, is the best language's beside any
other one. A flag rejects nothing: the text keeps the label of its larger part.
``in_a_language`` drops only texts without a language or with a score under ``NO_LANGUAGE``,
which many languages must share.

A bit's classifier is the mean log odds of the text's n-grams between the languages with +1 and
those with -1, each language weighing the same, however many texts it has. Its margin is divided
by the bit's spread on the training texts, so that all bits speak at the same scale.

The models are fitted on at most ``TRAIN_PER_LANGUAGE`` documents of each language, those with
the smallest hash of their ids and texts: counts of n-grams are summed in Spark, per language and
bucket and then per bucket and bit. Any number of languages is learned: the driver holds a number
per bucket and bit, and some per language and bit. Predictions read nothing but the text.

Defined cases: null texts and texts without a letter get ``und`` and score 0, as does every
text if no labelled document can be learned from; a single learned language is always the answer;
rows without an id or language are not learned from; repeated rows are predicted each and learned
from once; of languages that tie the first by name is the answer; very long texts are read in
blocks; an empty table gives an empty result. ``in_a_language`` returns the table's own columns,
whatever their names; of other columns ``identified`` reads none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstream.llm.common import map_texts, whole_row
from kerbstream.session import materialise

TRAIN_PER_LANGUAGE = 2000
BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
SMOOTHING = 0.5
BLOCK = 1 << 20  # bytes of a text whose n-grams are held at once
# An answer with less than this share beside any one other language is called ambiguous: halves,
# and parts up to about one third to two thirds.
BETWEEN = 2 / 3
# With less than this share of the whole belief a text is in no language. One of two languages in
# equal parts still has half of it.
NO_LANGUAGE = 0.4
UNKNOWN = "und"
EXHAUSTIVE = 7  # up to so many languages get all possible bits


# ---- n-grams --------------------------------------------------------------------------------

def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the byte n-grams of a lower-cased text, block by block."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    for at in range(0, max(1, len(data)), BLOCK):
        block = data[at:at + BLOCK + max(GRAMS) - 1]
        code = block
        for n in range(2, max(GRAMS) + 1):
            code = (code[:-1] << np.uint32(8)) | block[n - 1:]
            if n in GRAMS:
                # Grams that begin in this block, each in exactly one block.
                own = code[:BLOCK]
                mixed = (own + np.uint32(n)) * np.uint32(2654435761)
                yield (mixed >> np.uint32(32 - 15)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


# ---- codes ----------------------------------------------------------------------------------

def codewords(languages: int) -> np.ndarray:
    """A (languages, bits) matrix of +1 and -1, the same at every call.

    Few languages get every way to divide them in two; their codewords differ in more than
    half of the bits. Many get the best of several random codes.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=languages - 1)
                   if -1 in rest]
        return np.array(columns, np.int8).T
    bits, random = 15 * int(np.ceil(np.log2(languages))), np.random.default_rng(42)
    best, distance = None, -1
    tries = max(1, min(200, 50_000 // languages))
    while best is None or tries > 0:
        tries -= 1
        code = random.choice(np.array([-1, 1], np.int8), (languages, bits))
        gaps = (bits - code.astype(np.float32) @ code.T.astype(np.float32)) // 2
        np.fill_diagonal(gaps, bits)
        balanced = (np.abs(code.sum(axis=0)) < languages).all()
        if balanced and gaps.min() > distance:
            best, distance = code, gaps.min()
    return best


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    odds: np.ndarray  # (buckets, bits): log odds of each n-gram
    spread: np.ndarray  # (bits,)
    trust: np.ndarray  # (languages, bits): rows sum to 1
    typical: np.ndarray | None = None  # (languages, bits): mean margins of the training texts

    def margins(self, text: str) -> np.ndarray:
        total, count = np.zeros(self.code.shape[1]), 0
        for buckets in gram_buckets(text):
            total += self.odds[buckets].sum(axis=0, dtype=np.float64)
            count += len(buckets)
        return total / max(count, 1) / self.spread

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """The nearest language, the belief in it, a softmax over negative losses, and whether
        it is ambiguous."""
        loss = (self.trust * np.logaddexp(0.0, -self.code * margins)).sum(axis=1)
        belief = np.exp((loss.min() - loss) * self.code.shape[1])
        best = int(loss.argmin())  # the first by name if two are equal
        score = float(belief[best] / belief.sum())
        return self.languages[best], score, score < NO_LANGUAGE or self._between(
            margins, belief, best)

    def _between(self, margins: np.ndarray, belief: np.ndarray, best: int) -> bool:
        """Whether the text, or the belief, is divided between ``best`` and another language."""
        others = np.arange(len(belief)) != best
        if (belief[best] < BETWEEN * (belief[best] + belief[others])).any():
            return True
        if self.typical is None:
            return False
        way = self.typical[best] - self.typical[others]
        gone = ((margins - self.typical[others]) * way).sum(axis=1)
        return bool((gone < BETWEEN * (way * way).sum(axis=1)).any())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        return self.decode(self.margins(text))


# ---- training -------------------------------------------------------------------------------

def held_out(doc_id: Column | str) -> Column:
    """Every fourth document by the checksum of its id is never learned from."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> DataFrame:
    """(lang, text) of at most ``per_language`` documents per language, by hash of id and text.

    Equal rows count as one. Of a language with many documents only those whose hash is in its
    lowest part are ranked, about twice as many as are wanted, and only hashes are shuffled.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                           & F.col("text").isNotNull() & ~held_out("doc_id")).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("_hash"))
    hashes = labelled.select("lang", "_hash")
    counts = materialise(hashes.groupBy("lang").agg(F.count("*").alias("_all")), "languages")
    # Hashes run evenly from -2^63 to 2^63.
    low = F.col("_hash") / F.lit(2.0 ** 64) + 0.5 <= F.lit(2.0 * per_language) / F.col("_all")
    order = Window.partitionBy("lang").orderBy("_hash")
    chosen = hashes.join(counts, "lang").filter(low).select("lang", "_hash").distinct().select(
        "lang", "_hash", F.row_number().over(order).alias("_place"))
    chosen = materialise(chosen.filter(F.col("_place") <= per_language).select(
        "lang", "_hash"), "chosen")
    return materialise(labelled.join(chosen, ["lang", "_hash"], "left_semi").dropDuplicates(
        ["lang", "_hash"]).select("lang", "text"), "training")


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for buckets in gram_buckets(text):
                own += np.bincount(buckets, minlength=BUCKETS)
    for lang, own in counts.items():
        found = np.nonzero(own)[0]
        yield pd.DataFrame({"lang": lang, "bucket": found, "n": own[found]})


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> CodeModel:
    """A model from ``docs`` (doc_id, lang, text). The driver gets numbers per bucket and bit, and
    per language and bit, whatever the number of documents."""
    sample = training_sample(docs, per_language)
    counts = materialise(sample.mapInPandas(_count_grams, "lang string, bucket int, n long")
                         .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    # Texts too short for any n-gram still name their language.
    totals = {r.lang: 0 for r in sample.select("lang").distinct().collect()}
    totals |= {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    code = codewords(len(languages))
    weight = 1 / (np.array([totals[lang] for lang in languages], float) + SMOOTHING * BUCKETS)
    odds = _odds(counts, languages, code, weight)
    bits = code.shape[1]
    model = CodeModel(languages, code, odds, np.ones(bits), np.full(code.shape, 1 / bits))
    return _calibrated(model, sample) if len(languages) > 1 else model


def _odds(counts: DataFrame, languages: list[str], code: np.ndarray, weight: np.ndarray
          ) -> np.ndarray:
    """Per bucket and bit: the log of the bucket's mean share in the languages with +1, less that
    in those with -1. A share is (n + SMOOTHING) * weight. Each task sums the shares of some
    buckets, in the order of languages, so equal counts give equal bits."""
    bits = code.shape[1]
    shared = counts.sparkSession.sparkContext.broadcast((languages, code, weight))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, code, weight = shared.value
        place = {lang: i for i, lang in enumerate(names)}
        plus, minus = {}, {}
        for batch in batches:
            at = batch["lang"].map(place).to_numpy(int)
            share = (batch["n"].to_numpy() * weight[at])[:, None]
            buckets, where = np.unique(batch["bucket"].to_numpy(), return_inverse=True)
            for into, positive in ((plus, True), (minus, False)):
                total = np.stack([into.get(b, np.zeros(bits)) for b in buckets]) if len(
                    buckets) else np.zeros((0, bits))
                np.add.at(total, where, np.where((code[at] > 0) == positive, share, 0.0))
                into.update(zip(buckets.tolist(), total))
        yield pd.DataFrame({"bucket": list(plus), "plus": [v.tolist() for v in plus.values()],
                            "minus": [minus[b].tolist() for b in plus]})

    found = (counts.repartition("bucket").sortWithinPartitions("bucket", "lang")
             .mapInPandas(sums, "bucket int, plus array<double>, minus array<double>").toArrow())
    side = {name: np.zeros((BUCKETS, bits)) for name in ("plus", "minus")}
    for name, into in side.items():
        if found.num_rows:
            values = found[name].combine_chunks().flatten().to_numpy()
            into[found["bucket"].to_numpy()] = values.reshape(-1, bits)
        own = (code > 0) if name == "plus" else (code < 0)
        into += SMOOTHING * (own * weight[:, None]).sum(axis=0)
        into /= np.maximum(own.sum(axis=0), 1)
    both = (code > 0).any(axis=0) & (code < 0).any(axis=0)
    odds = np.zeros((BUCKETS, bits), np.float32)
    odds[:, both] = np.log(side["plus"][:, both]) - np.log(side["minus"][:, both])
    return odds


def _calibrated(model: CodeModel, sample: DataFrame) -> CodeModel:
    """Measure each bit on the training texts: its spread, and for each language how often it is
    right and its mean margin."""
    shared = sample.sparkSession.sparkContext.broadcast(model)
    bits = model.code.shape[1]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        place = {lang: i for i, lang in enumerate(own.languages)}
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                held.setdefault(lang, []).append(own.margins(text))
            for lang, rows in held.items():
                margins = np.array(rows)
                yield pd.DataFrame({
                    "lang": lang, "bit": np.arange(bits), "n": len(rows),
                    "size": np.abs(margins).sum(axis=0), "margin": margins.sum(axis=0),
                    "right": (margins * own.code[place[lang]] > 0).sum(axis=0).astype(float)})

    measured = ("size", "margin", "right")
    seen = (sample.mapInPandas(
                measure, "lang string, bit int, n long, size double, margin double, right double")
            .groupBy("lang", "bit").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in measured])
            .toPandas())
    place = {lang: i for i, lang in enumerate(model.languages)}
    rows, columns = seen["lang"].map(place).to_numpy(int), seen["bit"].to_numpy(int)
    size, margin, right = (np.zeros(model.code.shape) for _ in measured)
    for into, name in zip((size, margin, right), measured):
        into[rows, columns] = seen[name]
    trust = np.maximum(right, 1e-3)
    # A typical margin becomes 3: sure, but not beyond being outvoted.
    spread = np.maximum(np.round(size.mean(axis=0), 9) / 3, 1e-9)
    return CodeModel(model.languages, model.code, model.odds, spread,
                     trust / trust.sum(axis=1, keepdims=True), np.round(margin, 9) / spread)


# ---- the operator ---------------------------------------------------------------------------

def predicted(docs: DataFrame, model: CodeModel, text: str = "text",
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, lang_pred, score and ambiguous of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: list[str | None]) -> list[list]:
        found = [shared.value.predict(t) for t in texts]
        return [list(column) for column in zip(*found)] if found else [[], [], []]

    return map_texts(docs, list(keep), text,
                     "lang_pred string, score double, ambiguous boolean", predict)


def identified(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous, from a model learned from the
    documents that are not held out."""
    return predicted(docs, train(docs, per_language)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


def in_a_language(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> DataFrame:
    """``docs`` without those in no language: ``und``, or a score under ``NO_LANGUAGE``. Texts of
    two languages stay, also where the flag is set."""
    model = train(docs, per_language)
    whole = docs.select(whole_row(docs).alias("row"), F.col("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def sure(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in texts.to_pylist()]
        return pa.array([lang != UNKNOWN and score >= NO_LANGUAGE for lang, score, _ in found])

    return whole.filter(sure("text")).select("row.*")

"""Toxicity by a weighted finite-state pattern grammar.

*Grammar.* A text's words become symbols (insult, threat, intent, target, negation, report, other)
between marks (quote, break). Five transducers read them, each what the one before it writes:
insults and threats become matches; a negation shortly before a match, a person near it, and a
quotation or a verb of saying around it each mark the match and add a weight of their own. The
five are composed into one machine before any text is read. A match weighs its word's log
likelihood ratio times e to the sum of its marks' weights, so a negated or quoted insult weighs
less than one thrown at somebody. What is scored are matched clauses, with their spans; a word no
pattern matches (a threat without intent or target) scores nothing.

*Lexicon.* Insults are word beginnings. They are learned: each beginning of 3 to 8 letters in the
training texts is counted in toxic and other texts, the best are looked up in each text, and
then chosen one by one by the toxic texts that no chosen one explains yet. So a word that only
stands beside insults, as in copies of one text, is not chosen. A few common ones are always in.

*Score.* Logistic regression on a text's summed match weights, matched clauses and length.

*What is fitted on a sample*: at most ``SAMPLE`` texts per label, those with the smallest hashes of
id and text. The lexicon's candidates (``CANDIDATES`` at most) per sampled text and a row of sums
per sampled text reach the driver; both are bounded by these numbers. Held-out rows never take part,
and a score depends on the text alone.

Defined cases: null and empty texts match nothing and get the score of a text without a match.
Of several labels of an id, toxic counts; null labels and ids teach nothing. Without labels of both
kinds the common insults and the default weights decide. Repeated rows get equal scores. Long texts
are read line by line, and only lines that hold a word of the lexicon go through the machine. An
empty table gives an empty result. Of the table's columns only ``keep`` is returned, so others may
have any name.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstream.llm.common import map_texts
from kerbstream.session import materialise

SAMPLE = 2000
CANDIDATES = 1500
LEXICON = 400
LENGTHS = range(3, 9)  # letters of a beginning
MIN_TEXTS = 3  # toxic texts that a beginning must explain
MIN_RATIO = math.log(12)  # and how much likelier it must be in them
THRESHOLD = 0.3

# Words of the grammar, lower case, in four languages.
TARGETS = """you your yours he she they him her them du dich dir euch ihr er sie ihn tu te toi vous il
elle ils elles lui usted ustedes él ella ellos ti""".split()
NEGATIONS = """not no never neither nor without nicht kein keine keinen nie niemals pas jamais aucun
nunca jamás ni sin""".split()
REPORTS = """said says say wrote writes called calls claimed told reported quoted sagte sagt schrieb
nannte nennt behauptete dit disait écrit appelle dijo dice escribió llamó""".split()
INTENTS = """will shall gonna going must should want let werde werden wird will soll muss vais va allons
veux dois voy vamos quiero debo""".split()
THREATS = """kill hurt destroy beat burn shoot stab smash crush töten umbringen schlagen verbrennen
vernichten tuer frapper brûler détruire écraser matar golpear quemar destruir""".split()
INSULTS = """idiot moron stupid loser scum trash worthless pathetic disgusting clown trottel dumm
abschaum imbécil imbécile abruti estúpid basura""".split()

# Log ratios and weights before any label is seen.
INSULT_RATIO, THREAT_RATIO = 4.0, 4.0
MARKS = {"threat": 0.2, "negated": -0.9, "directed": 0.4, "reported": -0.7}
# (no match, a match, log of the summed weights, log of matched clauses, log of words)
COEFFICIENTS = (-4.0, -1.0, 2.4, 0.5, 0.0)
MARK_TRUST = 30  # matches that outweigh a mark's weight before any label
SEED_TRUST = 5  # occurrences that outweigh a common insult's ratio

INTENT_SPAN, OBJECT_SPAN, NEGATION_SPAN, TARGET_SPAN = 4, 2, 3, 4  # words


# ---- the grammar ----------------------------------------------------------------------------

OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE, BREAK = range(9)
INPUTS = range(9)
MATCH = 16  # a match, and the marks it can carry
MARK_BITS = {"threat": 1, "negated": 2, "directed": 4, "reported": 8}
KINDS = 16

# A transducer: (state, symbol) to the next state and the symbols written. The arcs that set a
# mark carry its weight; as each mark is set by one arc of one machine, the marks on a match tell
# the weight of the path that wrote it, however long a machine held it back.
Step = Callable[[tuple, int], tuple[tuple, list[int]]]


def insults(state: tuple, symbol: int) -> tuple[tuple, list[int]]:
    return state, [MATCH if symbol == INSULT else symbol]


def threats(state: tuple, symbol: int) -> tuple[tuple, list[int]]:
    """A threatening verb matches within a few words after an intent, or with a person shortly
    behind it. State: words an intent still reaches, words in which a verb awaits its object."""
    intent, verb = state
    found = MATCH | MARK_BITS["threat"]
    if symbol in (BREAK, QUOTE):
        return (0, 0), [symbol]
    if symbol == THREAT:
        if intent:
            return (intent - 1, 0), [found]
        return (0, OBJECT_SPAN), [OTHER]
    if symbol == TARGET and verb:
        return (max(intent - 1, 0), 0), [found, symbol]
    return (INTENT_SPAN if symbol == INTENT else max(intent - 1, 0), max(verb - 1, 0)), [symbol]


def negations(state: tuple, symbol: int) -> tuple[tuple, list[int]]:
    """State: words the last negation still reaches."""
    (left,) = state
    if symbol == BREAK:
        return (0,), [symbol]
    if symbol == QUOTE:
        return state, [symbol]
    if symbol == NEGATION:
        return (NEGATION_SPAN,), [symbol]
    marked = symbol | MARK_BITS["negated"] if symbol >= MATCH and left else symbol
    return (max(left - 1, 0),), [marked]


def targets(state: tuple, symbol: int) -> tuple[tuple, list[int]]:
    """A match is directed if a person stands a few words before or after it, so it is held back
    until that is known. State: the match held back, words it still waits, words the last person
    still reaches."""
    held, wait, near = state
    directed = MARK_BITS["directed"]
    if symbol in (BREAK, QUOTE):
        return (0, 0, 0), [*([held] if held else []), symbol]
    if symbol == TARGET:
        return (0, 0, TARGET_SPAN), [*([held | directed] if held else []), symbol]
    if symbol >= MATCH:
        before = [held] if held else []
        if near:
            return (0, 0, near - 1), [*before, symbol | directed]
        return (symbol, TARGET_SPAN, 0), before
    near, wait = max(near - 1, 0), max(wait - 1, 0)
    if held and not wait:
        return (0, 0, near), [held, symbol]
    return (held, wait, near), [symbol]


def reports(state: tuple, symbol: int) -> tuple[tuple, list[int]]:
    """State: whether a quotation is open, whether the clause has a verb of saying. Writes matches
    and breaks only."""
    quoted, said = state
    if symbol == QUOTE:
        return (1 - quoted, said), []
    if symbol == REPORT:
        return (quoted, 1), []
    if symbol == BREAK:
        return (quoted, 0), [symbol]
    if symbol >= MATCH:
        return state, [symbol | MARK_BITS["reported"] if quoted or said else symbol]
    return state, []


CASCADE: list[tuple[Step, tuple]] = [
    (insults, (0,)), (threats, (0, 0)), (negations, (0,)), (targets, (0, 0, 0)), (reports, (0, 0))]


def cascaded(states: tuple, symbol: int) -> tuple[tuple, tuple[int, ...]]:
    """One step of all machines, each reading what the one before it writes."""
    after, stream = list(states), [symbol]
    for i, (step, _) in enumerate(CASCADE):
        written = []
        for read in stream:
            after[i], out = step(after[i], read)
            written += out
        stream = written
    return tuple(after), tuple(stream)


@functools.lru_cache(maxsize=1)
def composed() -> list[list[tuple[int, tuple[int, ...]]]]:
    """One machine for the cascade: for each state that can be reached from the start (state 0)
    and each input, the next state and what is written."""
    queue = [tuple(start for _, start in CASCADE)]
    numbers, table = {queue[0]: 0}, []
    for states in queue:
        row = []
        for symbol in INPUTS:
            after, written = cascaded(states, symbol)
            if after not in numbers:
                numbers[after] = len(numbers)
                queue.append(after)
            row.append((numbers[after], written))
        table.append(row)
    return table


def path_weight(kind: int, marks: dict[str, float]) -> float:
    """The summed weights of the arcs that put these marks on a match."""
    return sum(marks[name] for name, bit in MARK_BITS.items() if kind & bit)


# ---- texts ----------------------------------------------------------------------------------

TOKENS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“”„«»]|[.!?;]")
WORDS = re.compile(r"[^\W_]+")


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    lower = text.lower()
    if len(lower) == len(text):
        return lower
    return "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


@dataclass
class Model:
    lexicon: dict[str, float] = field(
        default_factory=lambda: {word: INSULT_RATIO for word in INSULTS})
    marks: dict[str, float] = field(default_factory=lambda: dict(MARKS))
    coefficients: tuple[float, ...] = COEFFICIENTS


@dataclass
class Clause:
    start: int
    end: int
    kinds: list[int]
    ratios: list[float]


class Grammar:
    """A model made ready to read texts."""

    def __init__(self, model: Model):
        self.model = model
        self.table = composed()
        self.factors = [math.exp(path_weight(kind, model.marks)) for kind in range(KINDS)]
        self.classes = {word: symbol for symbol, words in (
            (INTENT, INTENTS), (REPORT, REPORTS), (TARGET, TARGETS), (NEGATION, NEGATIONS),
            (THREAT, THREATS)) for word in words}
        self.longest = max(map(len, model.lexicon), default=0)
        self.finder = ahocorasick.Automaton()
        for form in [*model.lexicon, *THREATS]:
            self.finder.add_word(form, len(form))
        self.finder.make_automaton()

    def ratio(self, word: str) -> float | None:
        """That of the longest beginning in the lexicon."""
        for k in range(min(len(word), self.longest), 0, -1):
            if word[:k] in self.model.lexicon:
                return self.model.lexicon[word[:k]]
        return None

    def lines(self, lower: str) -> Iterator[tuple[int, int]]:
        """Lines in which a word begins with a form that could match."""
        end = 0
        for last, size in self.finder.iter(lower):
            at = last + 1 - size
            if at < end or (at and (lower[at - 1].isalnum())):
                continue
            start = lower.rfind("\n", 0, at) + 1
            end = lower.find("\n", at)
            end = len(lower) if end < 0 else end
            yield start, end

    def clauses(self, text: str) -> list[Clause]:
        """The clauses with a match."""
        lower = lowered(text)
        return [clause for start, end in self.lines(lower)
                for clause in self._of_line(lower, start, end)]

    def _of_line(self, lower: str, start: int, end: int) -> Iterator[Clause]:
        state, ratios, begin, last = 0, [], None, start
        now = Clause(start, start, [], [])
        for symbol, at, last_of, ratio in self._symbols(lower, start, end):
            if begin is None and symbol != BREAK:
                begin = at
            if ratio is not None:
                ratios.append(ratio)
            state, written = self.table[state][symbol]
            for kind in written:
                if kind >= MATCH:
                    kind -= MATCH
                    now.kinds.append(kind)
                    # Insults are written in the order they are read.
                    now.ratios.append(THREAT_RATIO if kind & 1 else ratios.pop(0))
            if symbol != BREAK:
                last = last_of
            else:
                if now.kinds:
                    now.start, now.end = begin, last
                    yield now
                now, begin = Clause(start, start, [], []), None

    def _symbols(self, lower: str, start: int, end: int
                 ) -> Iterator[tuple[int, int, int, float | None]]:
        for found in TOKENS.finditer(lower, start, end):
            token, ratio = found.group(), None
            if token[0] in ".!?;":
                symbol = BREAK
            elif token[0] in "\"“”„«»":
                symbol = QUOTE
            else:
                ratio = self.ratio(token)
                if ratio is not None:
                    symbol = INSULT
                elif token.endswith(("n't", "n’t")):
                    symbol = NEGATION
                elif token.endswith(("'ll", "’ll")):
                    symbol = INTENT
                else:
                    symbol = self.classes.get(token, OTHER)
            yield symbol, found.start(), found.end(), ratio
        yield BREAK, end, end, None

    def sums(self, clauses: Iterable[Clause]) -> tuple[list[float], list[int]]:
        """Summed ratios, and matches, by kind."""
        total, count = [0.0] * KINDS, [0] * KINDS
        for clause in clauses:
            for kind, ratio in zip(clause.kinds, clause.ratios):
                total[kind] += ratio
                count[kind] += 1
        return total, count

    def weight(self, clause: Clause) -> float:
        return sum(self.factors[k] * r for k, r in zip(clause.kinds, clause.ratios))

    def score(self, clauses: list[Clause], words: int) -> float:
        x = features(sum(map(self.weight, clauses)), len(clauses), words)
        return float(probability(np.dot(x, self.model.coefficients)))


def features(strength, clauses, words) -> np.ndarray:
    """(1, a match, and with a match: log of strength, of clauses, of words)."""
    found = np.asarray(clauses) > 0
    return np.stack([np.ones(found.shape), found, found * np.log1p(strength),
                     found * np.log(np.maximum(clauses, 1)),
                     found * np.log(np.maximum(words, 1))], -1)


def probability(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# ---- learning -------------------------------------------------------------------------------

def beginnings(text: str) -> Counter:
    """How often each beginning of a word stands in a text."""
    out = Counter()
    for word, n in Counter(WORDS.findall(lowered(text))).items():
        for k in LENGTHS:
            if k > len(word):
                break
            out[word[:k]] += n
    return out


def log_ratio(toxic, other, words_toxic: float, words_other: float):
    """How much likelier an occurrence is in a toxic text, with one more on both sides."""
    return np.log((toxic + 1) / (words_toxic + 1)) - np.log((other + 1) / (words_other + 1))


def chosen_forms(forms: list[str], counts: np.ndarray, toxic: np.ndarray, weights: np.ndarray,
                 words: np.ndarray) -> dict[str, float]:
    """The lexicon from ``counts`` (texts by forms). One form at a time: the one whose likelihood
    ratio, times the toxic texts not explained so far, is highest. A text's ratios explain it as
    far as they outweigh the odds against toxicity."""
    against = math.log(weights[~toxic].sum() / weights[toxic].sum()) + 2
    per_text = counts * weights[:, None]
    ratio = log_ratio(per_text[toxic].sum(0), per_text[~toxic].sum(0),
                      (words * weights)[toxic].sum(), (words * weights)[~toxic].sum())
    holds, occurs = counts[toxic] > 0, counts[toxic].astype(float)
    explained, lexicon = np.zeros(len(occurs)), {}
    usable = ratio >= MIN_RATIO
    length = np.array([len(f) for f in forms])
    while usable.any() and len(lexicon) < LEXICON:
        open_ = 1 - probability(explained - against)
        texts = open_ @ holds
        gain = np.where(usable & (texts >= MIN_TEXTS), texts * ratio, 0)
        if not gain.max() > 0:
            break
        # Among equals the longest, as shorter beginnings catch more by chance.
        ties = np.flatnonzero(gain >= gain.max() * (1 - 1e-9))
        best = ties[np.argmax(length[ties])]
        lexicon[forms[best]] = float(ratio[best])
        explained += occurs[:, best] * ratio[best]
        usable &= np.array([not (f.startswith(forms[best]) or forms[best].startswith(f))
                            for f in forms])
    for i, form in enumerate(forms):
        if form in INSULTS and not any(form.startswith(f) for f in lexicon):
            seen = float(per_text[:, i].sum())
            lexicon[form] = max(0.0, (SEED_TRUST * INSULT_RATIO + seen * float(ratio[i]))
                                / (SEED_TRUST + seen))
    return lexicon


def learned_marks(count: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> dict[str, float]:
    """Each mark's weight: how much more or less a match with it speaks for toxicity than one
    without, drawn to its value before any label."""
    by_kind = np.stack([(count[side] * weights[side][:, None]).sum(0) for side in (toxic, ~toxic)])
    seen = count.sum(0)
    out = {}
    for name, bit in MARK_BITS.items():
        with_mark = np.array([bool(k & bit) for k in range(KINDS)])
        ratio = []
        for side in (with_mark, ~with_mark):
            a, b = by_kind[:, side].sum(1) + 1
            ratio.append(max(0.1, math.log(a / b * weights[~toxic].sum() / weights[toxic].sum())))
        n = float(seen[with_mark].sum())
        measured = math.log(ratio[0] / ratio[1])
        out[name] = (MARK_TRUST * MARKS[name] + n * measured) / (MARK_TRUST + n)
    return out


def fitted(x: np.ndarray, toxic: np.ndarray, weights: np.ndarray, ridge: float = 1.0,
           tolerance: float = 1e-9) -> tuple[float, ...]:
    """Logistic regression drawn to the default coefficients. Newton steps, halved where they do
    not lower the loss, until one changes nothing; the loss is convex, so they end at its only
    minimum."""
    start = np.array(COEFFICIENTS)
    beta, pull = start.copy(), ridge * np.ones(len(start))
    pull[:2] = 1e-3  # the base rates are free

    def loss(b):
        z = np.clip(x @ b, -30, 30)
        return (weights * (np.logaddexp(0, z) - toxic * z)).sum() + (pull * (b - start) ** 2).sum() / 2

    now = loss(beta)
    while True:
        p = probability(x @ beta)
        gradient = x.T @ (weights * (p - toxic)) + pull * (beta - start)
        curvature = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(pull)
        step, size = np.linalg.solve(curvature, gradient), 1.0
        while size > 1e-8 and loss(beta - size * step) > now:
            size /= 2
        after = loss(beta - size * step)
        if not after < now - tolerance * (1 + abs(now)):
            return tuple(float(b) for b in beta)
        beta, now = beta - size * step, after


def held_out(key: str = "doc_id") -> Column:
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame | None:
    """(text, toxic, weight) of at most ``sample`` texts per label; a weight is what the text
    stands for. None without both labels."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    known = materialise(known, "labels")
    sizes = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    by_id = F.xxhash64("doc_id")
    picked = [known.filter(F.col("toxic") == side).orderBy(by_id, "doc_id").limit(sample)
              for side in (True, False)]
    # At most two samples of ids, so the broadcast is bounded.
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select(
        "text", "toxic", F.xxhash64("doc_id", "text").alias("_hash"))
    parts = []
    for side in (True, False):
        own = rows.filter(F.col("toxic") == side)
        # An id may be repeated without end; equal rows count once, and the hash bounds the rest.
        hashes = own.select("_hash").distinct().orderBy("_hash").limit(sample)
        last, n = hashes.agg(F.max("_hash"), F.count("*")).first()
        if not n:
            return None
        parts.append(own.filter(F.col("_hash") <= last).dropDuplicates(["_hash"]).withColumn(
            "weight", F.lit(sizes[side] / n)))
    return materialise(parts[0].unionByName(parts[1]).drop("_hash"), "toxicity-sample")


def _counted_beginnings(batches):
    """(form, texts, toxic) partial counts of each batch."""
    for batch in batches:
        sides = {True: Counter(), False: Counter()}
        for text, toxic in zip(*(batch.column(i).to_pylist() for i in range(2))):
            sides[toxic].update(beginnings(text or "").keys())
        for toxic, counts in sides.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()),
                 pa.array([toxic] * len(counts), pa.bool_())], names=["form", "texts", "toxic"])


def candidates(sample: DataFrame) -> list[str]:
    """The word beginnings that are best at telling toxic texts apart, and the common insults."""
    counted = sample.select("text", "toxic").mapInArrow(
        _counted_beginnings, "form string, texts long, toxic boolean")
    n = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    toxic, other = (F.sum(F.when(F.col("toxic") == side, F.col("texts")).otherwise(0))
                    for side in (True, False))
    ratio = F.log((F.col("a") + 1) / (n[True] + 1)) - F.log((F.col("b") + 1) / (n[False] + 1))
    best = (counted.groupBy("form").agg(toxic.alias("a"), other.alias("b"))
            .filter(F.col("a") >= MIN_TEXTS).withColumn("gain", F.col("a") * ratio)
            .filter("gain > 0").orderBy(F.desc("gain"), "form").limit(CANDIDATES))
    found = [row.form for row in best.select("form").collect()]
    return sorted({*found, *INSULTS})


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents that are not held out."""
    texts = training_texts(docs, labels, sample)
    if texts is None:
        return Model()
    forms = candidates(texts)
    index = {form: i for i, form in enumerate(forms)}

    def looked_up(batch: list[str | None]) -> list[list]:
        found = [beginnings(text or "") for text in batch]
        held = [[(index[f], n) for f, n in counts.items() if f in index] for counts in found]
        short = pa.list_(pa.int32())
        return [pa.array([[i for i, _ in row] for row in held], short),
                pa.array([[n for _, n in row] for row in held], short),
                [len((text or "").split()) for text in batch]]

    rows = map_texts(texts, ["toxic", "weight"], "text",
                     "at array<int>, times array<int>, words long", looked_up).toArrow()
    toxic = rows["toxic"].to_numpy(zero_copy_only=False).astype(bool)
    weights, words = (rows[c].to_numpy().astype(float) for c in ("weight", "words"))
    counts = np.zeros((len(toxic), len(forms)), np.int32)
    for i, (at, times) in enumerate(zip(rows["at"].to_pylist(), rows["times"].to_pylist())):
        counts[i, at] = times
    lexicon = chosen_forms(forms, counts, toxic, weights, words)

    def matched(grammar: Grammar, batch: list[str | None]) -> list[list]:
        made = [grammar.clauses(text or "") for text in batch]
        sums = [grammar.sums(clauses) for clauses in made]
        return [[s for s, _ in sums], [n for _, n in sums], [len(c) for c in made],
                [len((text or "").split()) for text in batch]]

    rows = map_texts(texts, ["toxic", "weight"], "text",
                     "sums array<double>, matches array<long>, clauses long, words long",
                     matched, load=lambda: Grammar(Model(lexicon))).toArrow()
    toxic = rows["toxic"].to_numpy(zero_copy_only=False).astype(bool)
    weights = rows["weight"].to_numpy().astype(float)
    sums, matches = (np.array(rows[c].to_pylist(), float).reshape(-1, KINDS)
                     for c in ("sums", "matches"))
    marks = learned_marks(matches, toxic, weights)
    factors = np.exp([path_weight(kind, marks) for kind in range(KINDS)])
    x = features(sums @ factors, rows["clauses"].to_numpy(), rows["words"].to_numpy())
    return Model(lexicon, marks, fitted(x, toxic, weights))


# ---- scoring --------------------------------------------------------------------------------

CLAUSES = "array<struct<begin: long, end: long, marks: array<string>, weight: double>>"


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, score, predicted, and the matched clauses: their places in the text (code
    points), the marks of their matches, and their weights. Nothing is shuffled."""
    handed = docs.sparkSession.sparkContext.broadcast(model)

    def read(grammar: Grammar, texts: list[str | None]) -> list:
        scores, found = [], []
        for whole in texts:
            clauses = grammar.clauses(whole or "")
            scores.append(grammar.score(clauses, len((whole or "").split()) if clauses else 0))
            found.append([
                {"begin": c.start, "end": c.end, "weight": grammar.weight(c),
                 "marks": sorted({name for k in c.kinds for name, bit in MARK_BITS.items()
                                  if k & bit})} for c in clauses])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()),
                                   ("marks", pa.list_(pa.string())), ("weight", pa.float64())]))
        return [pa.array(scores, pa.float64()), pa.array(found, kind)]

    made = map_texts(docs, list(keep), text, f"score double, clauses {CLAUSES}", read,
                     load=lambda: Grammar(handed.value))
    return made.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                       "clauses")


def judged_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and how many clauses matched."""
    return scored(docs, learned(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted",
        F.size("clauses").alias("matched_clauses"))
